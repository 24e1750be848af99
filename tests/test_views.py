"""The view layer reproduces the figures FIXTURES.md documents for sf0.001."""

from pyspark.sql import functions as F

from tierwise.operators import tiers as T
from tierwise.sources.model import from_tpch

SF = "/root/testdata/sf0.001"


def test_fixture_figures(spark):
    t = from_tpch(spark, SF)
    assert t.customers.count() == 150 and t.products.count() == 200
    assert t.transactions.count() == 6000  # every line
    ids = t.numbered()
    assert ids.agg(F.min("txn_id"), F.max("txn_id"), F.count_distinct("txn_id")).first() == (1, 6000, 6000)
    same = ["customer_id", "product_id", "quantity", "txn_date"]
    assert ids.select(same).exceptAll(t.transactions.select(same)).isEmpty()
    assert t.customers.where(F.col("segment").isNull()).count() == 3
    tiers = {r["new_tier"]: r["count"] for r in T.customer_tiers(t).groupBy("new_tier").count().collect()}
    assert tiers == {"GOLD": 52, "SILVER": 56, "BRONZE": 42}
    assert T.tier_update_count(t).first()["updated_count"] == 101

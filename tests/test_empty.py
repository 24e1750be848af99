"""Every operator accepts an empty star."""

from pyspark.sql import functions as F

from star import star
from tierwise.operators import quality as Q
from tierwise.operators import reports as R
from tierwise.operators import tiers as T
from tierwise.operators import windows as W
from tierwise.operators.ordered import global_row_number, lag_within, rank_within, row_number_within
from tierwise.operators.spend import transaction_details


def test_empty_star(spark):
    t = star(spark, [], [], [])
    for df in (T.customer_tiers(t), T.tier_changes(t), T.apply_tier_changes(t), R.top_customers(t),
               R.top_n_per_tier(t), R.revenue_by_category(t), Q.validate_tiers(t), Q.tier_mismatches(t),
               Q.duplicate_customers(t), transaction_details(t), W.days_between_txns(t), W.product_rank(t),
               W.date_spine_revenue(t)):
        assert df.count() == 0
    assert T.tier_update_count(t).first()["updated_count"] == 0
    assert T.idempotent_second_run(t).first()["second_run_changes"] == 0
    assert {r["status"] for r in Q.tier_band_check(t).collect()} == {"SKIPPED"}
    assert Q.orphan_customers(t).first()["orphaned_count"] == 0
    assert R.tier_stats(t).count() == 0
    rep = Q.validation_report(t, {"customers": 0, "products": 0, "sales_transactions": 0}).collect()
    assert {r["Status"] for r in rep} == {"PASS"}
    e = t.transactions
    assert global_row_number(e, ["txn_id"]).count() == 0
    assert lag_within(e, ["customer_id"], ["txn_id"], "txn_date", "p").count() == 0
    assert row_number_within(e, ["customer_id"], ["txn_id"]).count() == 0
    assert rank_within(e, ["customer_id"], [F.col("quantity")], ["quantity"], ["txn_id"], "r").count() == 0

from decimal import Decimal

from pyspark.sql import functions as F

from tierwise.functions.money import avg_half_up
from tierwise.rules import DEFAULT_RULES, TierRules


def test_tier_boundaries(spark):
    cases = [(5000, "GOLD"), (3000, "GOLD"), (2999, "SILVER"), (1000, "SILVER"), (999, "BRONZE"), (0, "BRONZE"),
             (Decimal("2999.99"), "SILVER"), (Decimal("999.99"), "BRONZE"), (None, "BRONZE")]
    df = spark.createDataFrame([(Decimal(str(s)) if s is not None else None, e) for s, e in cases],
                               "spend decimal(38,2), expected string")
    got = df.select(DEFAULT_RULES.tier_of(F.col("spend")).alias("t"), "expected").collect()
    assert all(r["t"] == r["expected"] for r in got)


def test_rank_and_band():
    r = DEFAULT_RULES
    assert r.tiers == ["GOLD", "SILVER", "BRONZE"]
    assert r.band("GOLD") == (Decimal(3000), None)
    assert r.band("SILVER") == (Decimal(1000), Decimal(3000))
    assert r.band("BRONZE") == (None, Decimal(1000))


def test_rules_validate():
    import pytest

    with pytest.raises(ValueError):
        TierRules(thresholds=(("A", Decimal(1)), ("B", Decimal(2))))
    with pytest.raises(ValueError):
        TierRules(zero_spend="maybe")


def test_half_cent_average_rounds_up(spark):
    df = spark.createDataFrame([(Decimal("1.00"),), (Decimal("1.01"),)], "x decimal(10,2)")
    assert df.agg(avg_half_up("x").alias("a")).first()["a"] == Decimal("1.01")
    neg = spark.createDataFrame([(Decimal("-1.00"),), (Decimal("-1.01"),)], "x decimal(10,2)")
    assert neg.agg(avg_half_up("x").alias("a")).first()["a"] == Decimal("-1.01")
    empty = spark.createDataFrame([], "x decimal(10,2)")
    assert empty.agg(avg_half_up("x").alias("a")).first()["a"] is None

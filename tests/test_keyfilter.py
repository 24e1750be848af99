"""The bit table drops fact rows of other keys before any exchange."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tierwise.operators.keyfilter import MAX_BITS, MIN_BITS, bits_for, estimated_rows, keep_keys, key_bits
from tierwise.operators.reports import of_tier
from tierwise.operators.spend import spend_by_customer
from tierwise.sources.model import from_tpch

SF = "/root/testdata/sf0.01"


def test_every_key_of_the_dimension_stays(spark):
    dim = spark.range(0, 40000, 7).selectExpr("IF(id = 7, NULL, id) AS k")
    fact = spark.range(0, 60000).selectExpr("IF(id % 1000 = 1, NULL, id) AS k", "id AS row")
    kept = keep_keys(fact, dim, "k", MIN_BITS)
    assert kept.where("k IS NULL").isEmpty()
    joined = {r.row for r in fact.join(dim, "k", "left_semi").collect()}
    rows = {r.row for r in kept.collect()}
    assert joined <= rows
    # at most one bit in eleven is set, and a foreign key passes only on one of those
    assert len(rows) - len(joined) < 60000 * 0.12


def test_repeated_keys_empty_sides_and_string_keys(spark):
    dim = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    fact = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "k string, n int")
    assert sorted(r.n for r in keep_keys(fact, dim, "k").collect()) == [1, 2]
    assert keep_keys(fact, dim.where("false"), "k").collect() == []
    assert keep_keys(fact.where("false"), dim, "k").collect() == []


def test_size_is_bounded_and_types_must_agree(spark):
    assert bits_for(0) == MIN_BITS and bits_for(10**12) == MAX_BITS and bits_for(10**5) == 1 << 20
    assert bits_for(estimated_rows(spark.range(10**5))) == 1 << 20
    words = key_bits(spark.range(10**5), "id", MIN_BITS).first().words
    assert len(words) == MIN_BITS // 64
    with pytest.raises(ValueError):
        key_bits(spark.range(3), "id", 1000)
    with pytest.raises(TypeError):
        keep_keys(spark.range(3), spark.range(3).selectExpr("CAST(id AS INT) AS id"), "id")


def test_only_keys_of_the_tier_are_shuffled(spark):
    """Customers that reach the exchange of the spend aggregate: those of the
    tier, and no one else but the few that share a bit."""
    t = from_tpch(spark, SF)
    own = {r.customer_id for r in t.customers.where("segment = 'GOLD'").collect()}
    seen = {r.customer_id for r in spend_by_customer(of_tier(t, "GOLD")).collect()}
    others = t.customers.count() - len(own)
    # the table has eight bits a key at least, so at most one other key in eight passes
    assert len(seen - own) <= others / 8 and others > len(own)
    large = {r.customer_id for r in spend_by_customer(of_tier(t, "GOLD", 1 << 22)).collect()}
    assert len(large - own) <= 2 and large & own == seen & own
    buying = {r.customer_id for r in t.transactions.where(F.col("customer_id").isin(*own)).select("customer_id").distinct().collect()}
    assert buying <= seen


def test_filter_sits_on_the_orders_scan(spark):
    """Below the first join, so that rows of other tiers go before it."""
    p = E.queries()["top_gold"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert any("getbit" in line and "xxhash64(o_custkey" in line and "Filter" in line for line in p.splitlines()), p

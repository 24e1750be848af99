import pytest

from tierwise.operators.generate import GenSpec
from tierwise.plans.pipeline import changes_sample, process_tiers_job, run_pipeline, summary_status
from tierwise.sources.store import StarStore, VersionedTable


def test_versions(spark, scratch):
    vt = VersionedTable(spark, f"{scratch}/t")
    assert vt.current_version() is None
    v1 = vt.write(spark.range(3))
    v2 = vt.write(spark.range(5))
    assert (v1, v2) == (1, 2) and vt.read().count() == 5
    assert vt.read(1).count() == 3 and vt.versions() == [1, 2]


def test_failed_write_keeps_current(spark, scratch):
    vt = VersionedTable(spark, f"{scratch}/t")
    vt.write(spark.range(3))
    bad = spark.range(5).selectExpr("IF(id = 4, raise_error('boom'), id) AS id")
    with pytest.raises(Exception):
        vt.write(bad)
    assert vt.current_version() == 1 and vt.read().count() == 3
    assert vt.write(spark.range(7)) == 3 and vt.read().count() == 7  # the failed number isn't reused


def test_pipeline_end_to_end(spark, scratch):
    res = run_pipeline(spark, f"{scratch}/star", GenSpec(seed=7))
    assert sum(res.before.values()) == 500 and res.before["BRONZE"] == 500
    assert sum(res.after.values()) == 500  # conservation
    assert res.updated == 500 - res.after["BRONZE"]
    assert summary_status(res.report) == "PASS", res.report
    store = StarStore(spark, f"{scratch}/star")
    assert changes_sample(store, 5).count() == 5
    # second run changes nothing
    updated, _, _ = process_tiers_job(store)
    assert updated == 0


def test_partitioned_fact_and_clustered_customers(spark, scratch):
    from pyspark.sql import functions as F

    from tierwise.operators.generate import generate
    from tierwise.plans.pipeline import load_star, tables_from_store

    g = generate(spark, GenSpec(customers=80, products=10, transactions=2000, seed=5))
    store = StarStore(spark, f"{scratch}/star")
    load_star(store, g, partition_fact=True)
    raw = store["sales_transactions"].read()
    assert {"txn_year", "txn_month"} <= set(raw.columns)
    t = tables_from_store(store)
    assert t.transactions.columns == ["txn_id", "customer_id", "product_id", "quantity", "txn_date"]
    a = sorted(tuple(r) for r in t.transactions.collect())
    b = sorted(tuple(r) for r in g["sales_transactions"].collect())
    assert a == b
    assert raw.select("txn_year", "txn_month", F.input_file_name()).distinct().count() <= 13 * 4  # few files a month
    day = t.transactions.agg(F.max("txn_date")).first()[0].replace(day=1)
    late = tables_from_store(store, first_day=day).transactions
    p = late._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in p and "txn_year" in p.split("PartitionFilters: [")[1].split("]")[0]
    assert late.count() == g["sales_transactions"].where(F.col("txn_date") >= F.lit(day)).count() > 0


def test_errors_propagate(spark, scratch):
    """A missing table or a bad schema raises; nothing turns an error into 0."""
    from pyspark.errors import AnalysisException

    from tierwise.operators.tiers import tier_count
    from tierwise.plans.pipeline import tables_from_store

    with pytest.raises(FileNotFoundError):
        tables_from_store(StarStore(spark, f"{scratch}/empty"))
    with pytest.raises(AnalysisException):
        tier_count(spark.range(3), "GOLD").collect()

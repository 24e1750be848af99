"""The physical plans keep the properties the design relies on."""

import contextlib
import io

import __spark_entry__ as E

SF = "/root/testdata/sf0.01"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_spend_reads_only_its_columns_and_numbers_nothing(spark):
    p = plan(E.queries()["customer_spend"](spark, SF))
    assert "Window" not in p and "rangepartitioning" not in p and "ExistingRDD" not in p  # no numbering, sort or checkpoint
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in p
    assert "NestedLoop" not in p and "Cartesian" not in p
    # map-side partial aggregation: a hot customer is one row per partition
    assert "partial_sum" in p


def test_composing_a_query_runs_no_job(spark):
    """Only the queries that fix an order, a change set, the source of
    a merge or a computed side of a comparison run jobs before their result is asked for; reading a table's schema
    is one small job of its own."""
    tracker = spark.sparkContext.statusTracker()
    for name in ("apply_tier_changes", "customer_spend", "top_customers",
                 "revenue_by_category", "validation_report"):
        spark.sparkContext.setJobGroup(f"compose-{name}", name)
        E.queries()[name](spark, SF)
        stages = [s for j in tracker.getJobIdsForGroup(f"compose-{name}") for s in tracker.getJobInfo(j).stageIds]
        assert {tracker.getStageInfo(s).name.split(" at ")[0] for s in stages} <= {"parquet"}, name
    spark.sparkContext.setJobGroup("tests", "tests")


def test_top_n_per_tier_limits_before_exchange(spark):
    p = plan(E.queries()["top_n_per_tier"](spark, SF))
    assert p.count("WindowGroupLimit") >= 2  # partial (before exchange) and final


def test_nothing_is_broadcast_beyond_the_threshold(spark):
    """No hints: with Spark's size threshold off, every join shuffles."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("customer_spend", "apply_tier_changes", "top_customers", "revenue_by_category"):
            assert "BroadcastHashJoin" not in plan(E.queries()[name](spark, SF)), name
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_cross_joins_anywhere(spark):
    from tierwise.plans.registry import QUERIES

    for name, fn in QUERIES.items():
        if name in ("product_rank", "days_between_txns", "assign_surrogate_key"):
            continue  # eager checkpoint jobs; covered in test_ordered
        p = plan(fn(spark, SF))
        assert "NestedLoop" not in p and "Cartesian" not in p, name


def test_details_sort_and_store_no_fact(spark):
    """Rank selection: a top-k and a count, with the cut pushed to the scan."""
    p = plan(E.queries()["transaction_details"](spark, SF))
    assert "rangepartitioning" not in p and "ExistingRDD" not in p
    assert "LessThanOrEqual(l_orderkey,ScalarSubquery" in p


def test_report_reads_the_fact_once(spark):
    """One scan of the fact's columns; the raw row count reads no column."""
    p = plan(E.queries()["validation_report"](spark, SF))
    schemas = [line for line in p.splitlines() if line.startswith("ReadSchema")]
    assert sum("l_partkey" in s for s in schemas) == 1
    assert sum("l_" in s for s in schemas) == 1
    assert "NestedLoop" not in p and "Cartesian" not in p


def test_merge_computes_its_source_once(spark):
    """No scan of the source is left in the merge's own plan: the one job that
    checkpoints the source reads the fact, once."""
    for name in ("merge_upsert", "merge_metrics"):
        p = plan(E.queries()[name](spark, SF))
        assert "l_orderkey" not in p and "Scan ExistingRDD" in p, name

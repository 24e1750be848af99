import pytest
from pyspark.sql import functions as F

from tierwise.operators.compare import compare_tables
from tierwise.operators.merge import WhenMatched, WhenNotMatched, delete_where, merge, merge_metrics, merged_rows


def test_upsert_delete_metrics(spark):
    tgt = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "n")], "k bigint, v string")
    src = spark.createDataFrame([(1, "A"), (2, "b"), (4, "D"), (3, "X")], "k bigint, v string")
    tagged = merge(
        tgt, src, "k",
        matched=[WhenMatched(delete=True, condition=F.col("s.v") == "X"),
                 WhenMatched(update={"v": F.col("s.v")}, condition=F.col("t.v") != F.col("s.v"))],
        not_matched=WhenNotMatched(values={"k": F.col("s.k"), "v": F.col("s.v")}),
    )
    out = {r["k"]: r["v"] for r in merged_rows(tagged).collect()}
    assert out == {1: "A", 2: "b", 4: "D", None: "n"}
    m = {r["action"]: r["row_count"] for r in merge_metrics(tagged).collect()}
    assert m == {"update": 1, "keep": 2, "insert": 1, "delete": 1}


def test_delete_where_keeps_null(spark):
    df = spark.createDataFrame([(1, "x"), (2, None), (3, "y")], "k int, v string")
    assert sorted(r.k for r in delete_where(df, F.col("v") == "x").collect()) == [2, 3]


def test_compare(spark):
    a = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string")
    b = spark.createDataFrame([(1, "a"), (2, "B"), (3, None), (4, "d")], "k int, v string")
    got = {r.status: r.row_count for r in compare_tables(a, b, "k").collect()}
    assert got == {"same": 2, "changed": 1, "only_right": 1}


def _upsert(spark, target, source, condition=None):
    tgt = spark.createDataFrame(target, "k bigint, v string")
    src = spark.createDataFrame(source, "k bigint, v string")
    return merge(
        tgt, src, "k", matched=[WhenMatched(update={"v": F.col("s.v")}, condition=condition)],
        not_matched=WhenNotMatched(values={"k": F.col("s.k"), "v": F.col("s.v")}),
    )


def test_unmatched_source_rows_are_all_inserted(spark):
    tagged = _upsert(spark, [(1, "a"), (None, "n")], [(2, "x"), (2, "y"), (None, "p"), (None, "q")])
    rows = sorted(((r.k, r.v, r._action) for r in tagged.collect()), key=str)
    assert rows == sorted([(1, "a", "keep"), (None, "n", "keep"), (2, "x", "insert"), (2, "y", "insert"),
                           (None, "p", "insert"), (None, "q", "insert")], key=str)


def test_only_acting_source_rows_are_ambiguous(spark):
    differs = F.col("s.v") != F.col("t.v")
    target = [(1, "a"), (1, "a"), (2, "b"), (3, "c")]
    # key 1: neither row acts; key 2: one of two acts; key 3: one row
    tagged = _upsert(spark, target, [(1, "a"), (1, None), (2, "b"), (2, "B"), (3, "C")], differs)
    rows = sorted((r.k, r.v, r._action) for r in tagged.collect())
    assert rows == [(1, "a", "keep"), (1, "a", "keep"), (2, "B", "update"), (3, "C", "update")]


def test_two_acting_source_rows_fail(spark):
    with pytest.raises(Exception, match="more than one source row acts"):
        _upsert(spark, [(1, "a")], [(1, "x"), (1, "y")]).collect()


def test_keyed_source_checks_its_key(spark):
    tgt = spark.createDataFrame([(1, "a")], "k bigint, v string")
    src = spark.createDataFrame([(1, "x"), (1, "x")], "k bigint, v string")
    with pytest.raises(Exception, match="more than one source row acts"):
        merge(tgt, src, "k", matched=[WhenMatched(update={"v": F.col("s.v")})], keyed_source=True).collect()


def test_source_is_the_same_for_every_clause(spark):
    """A source that draws other values whenever it is run."""
    tgt = spark.range(50).selectExpr("id AS k", "'old' AS v")
    src = spark.range(100).selectExpr("CAST(rand() * 100 AS BIGINT) AS k", "uuid() AS v").dropDuplicates(["k"])
    tagged = merge(tgt, src, "k", matched=[WhenMatched(update={"v": F.col("s.v")})],
                   not_matched=WhenNotMatched(values={"k": F.col("s.k"), "v": F.col("s.v")}))
    one, two = (sorted(tuple(r) for r in tagged.collect()) for _ in range(2))
    assert one == two


@pytest.mark.parametrize("cluster_by", [None, ["k"]])
def test_write_reports_the_counts_of_its_own_job(spark, scratch, cluster_by):
    from tierwise.sources.store import VersionedTable

    tgt = spark.range(100).selectExpr("id AS k", "'a' AS v")
    src = spark.range(90, 130).selectExpr("id AS k", "IF(id < 95, 'X', 'b') AS v")
    tagged = merge(tgt, src, "k",
                   matched=[WhenMatched(delete=True, condition=F.col("s.v") == "X"), WhenMatched(update={"v": F.col("s.v")})],
                   not_matched=WhenNotMatched(values={"k": F.col("s.k"), "v": F.col("s.v")}, condition=F.col("s.k") < 120))
    table = VersionedTable(spark, f"{scratch}/t")
    version, counts = table.write_merged(tagged, cluster_by=cluster_by)
    assert counts == {"update": 5, "insert": 20, "delete": 5, "keep": 90}
    metrics = {r.action: r.row_count for r in merge_metrics(tagged).collect()}
    assert counts == metrics
    assert table.read(version).columns == ["k", "v"] and table.read(version).count() == 115
    assert table.write_counted(spark.range(7), cluster_by=["id"])[1] == 7
    assert table.write_counted(spark.range(7).where("id > 9"))[1] == 0


@pytest.mark.parametrize("buckets", [1, 7, 1 << 16])
def test_compare_by_fingerprints_equals_the_full_join(spark, buckets):
    """Changed, lost, new and NULL-key rows, and NULLs that swap columns."""
    from tierwise.operators.compare import compare_columns, compare_rows

    a = spark.range(300).selectExpr("IF(id = 9, NULL, id) AS k", "IF(id = 5, NULL, 'x') AS v", "IF(id = 5, 'x', NULL) AS w", "id AS own")
    b = spark.range(4, 310).selectExpr("id AS k", "IF(id % 50 = 0, 'y', IF(id = 77, NULL, 'x')) AS v", "CAST(NULL AS STRING) AS w")
    expect = {r["status"]: r["count"] for r in compare_rows(a, b, "k").groupBy("status").count().collect()}
    assert {r.status: r.row_count for r in compare_tables(a, b, "k", buckets).collect()} == expect
    got = {r["column"]: (r.changed, r.became_null, r.was_null) for r in compare_columns(a, b, "k", buckets).collect()}
    assert got == {"v": (7, 1, 1), "w": (1, 1, 0)}


def test_compare_of_equal_and_empty_tables_joins_no_rows(spark):
    from tierwise.operators.compare import _split, compare_columns

    a = spark.range(1000).selectExpr("id AS k", "id % 7 AS v")
    b = a.repartition(5)
    _, lt, rt = _split(a, b, ["k"], 64)
    assert lt.isEmpty() and rt.isEmpty()
    assert [tuple(r) for r in compare_tables(a, b, "k").collect()] == [("same", 1000)]
    assert [tuple(r) for r in compare_columns(a, b, "k").collect()] == [("v", 0, 0, 0)]
    none = a.where("false")
    assert compare_tables(none, none, "k").collect() == []
    assert [tuple(r) for r in compare_tables(none, a, "k").collect()] == [("only_right", 1000)]
    changed = a.selectExpr("k", "IF(k = 3, 99, v) AS v")
    _, lt, rt = _split(a, changed, ["k"], 64)
    assert 1 <= lt.count() < 100  # one bucket of sixty-four


def test_merge_delete_reads_transactions_of_any_age(spark):
    """However old a customer's transactions are, they keep the customer."""
    import datetime as dt

    from star import price, star

    from tierwise.plans.queries_extra import AS_OF, INACTIVE_DAYS, merge_delete

    long_ago, lately = AS_OF - dt.timedelta(days=INACTIVE_DAYS + 1), AS_OF - dt.timedelta(days=INACTIVE_DAYS)
    customers = [(1, "Customer_1", "GOLD", long_ago), (2, "Customer_2", "GOLD", long_ago), (3, "Customer_3", "GOLD", lately),
                 (4, "Customer_4", "GOLD", long_ago)]
    txns = [(1, 1, 1, 1, dt.date(1992, 1, 1)), (2, 4, 1, 1, AS_OF)]
    t = star(spark, customers, [(1, "Product_1", "Home", price(10))], txns)
    assert sorted(r.customer_id for r in merge_delete(t).collect()) == [1, 3, 4]

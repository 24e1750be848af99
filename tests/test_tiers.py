from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from star import D, basic, price, star
from tierwise.operators import quality as Q
from tierwise.operators import reports as R
from tierwise.operators import tiers as T
from tierwise.operators.spend import customer_spend
from tierwise.rules import TierRules


def rows(df, key="customer_id"):
    return {r[key]: r.asDict() for r in df.collect()}


def test_spend_and_tiers(spark):
    t = basic(spark)
    tiers = rows(T.customer_tiers(t))
    assert tiers[1]["total_spend"] == Decimal("5000.00") and tiers[1]["new_tier"] == "GOLD"
    assert tiers[2]["new_tier"] == "SILVER"
    assert tiers[3]["new_tier"] == "GOLD"  # exactly 3000
    assert tiers[6]["total_spend"] == Decimal("999.99") and tiers[6]["new_tier"] == "BRONZE"
    assert 4 not in tiers  # no transactions: untouched (keep)


def test_changes_skip_null_and_unchanged(spark):
    ch = rows(T.tier_changes(basic(spark)))
    assert set(ch) == {2, 3, 6}  # 1 unchanged, 4 no spend, 5 NULL segment
    assert T.tier_update_count(basic(spark)).first()["updated_count"] == 3


def test_apply_and_idempotent(spark):
    t = basic(spark)
    after = rows(T.apply_tier_changes(t))
    assert after[2]["segment"] == "SILVER" and after[3]["segment"] == "GOLD" and after[6]["segment"] == "BRONZE"
    assert after[4]["segment"] == "GOLD" and after[5]["segment"] is None
    assert T.idempotent_second_run(t).first()["second_run_changes"] == 0
    shift = rows(T.tier_shift(t), "segment")
    assert shift["GOLD"]["before"] == 3 and shift["GOLD"]["after"] == 3
    assert shift["SILVER"]["change"] == 0 and shift["BRONZE"]["change"] == 0


def test_zero_spend_assign(spark):
    t = basic(spark, TierRules(zero_spend="assign"))
    ch = rows(T.tier_changes(t))
    assert ch[4]["new_tier"] == "BRONZE" and ch[4]["total_spend"] == Decimal("0.00")


def test_validation_zero_spend_fails_under_keep(spark):
    v = rows(Q.validate_tiers(basic(spark)))
    assert v[4]["validation_result"] == "FAIL" and v[4]["expected_tier"] == "BRONZE"
    assert v[5]["validation_result"] == "FAIL"  # NULL segment
    assert v[1]["validation_result"] == "PASS"


def test_orphans_and_nulls(spark):
    customers = [(1, "a", "GOLD", D), (1, "a", "GOLD", D), (2, "b", "SILVER", D)]
    products = [(1, "p", "Home", price(10))]
    txns = [(1, 1, 1, 1, D), (2, 99, 1, 1, D), (3, 1, 77, 1, D), (4, None, 1, 1, D)]
    t = star(spark, customers, products, txns)
    assert Q.orphan_customers(t).first()["orphaned_count"] == 2  # unknown + NULL
    assert Q.orphan_products(t).first()["orphaned_count"] == 1
    dup = Q.duplicate_customers(t).collect()
    assert [(r["customer_id"], r["cnt"]) for r in dup] == [(1, 2)]
    nulls = {(r["table"], r["column"]): r["null_count"] for r in Q.null_checks(t).collect()}
    assert nulls[("sales_transactions", "customer_id")] == 1
    # the join counts a duplicated customer's spend once per copy
    assert rows(customer_spend(t))[1]["total_spend"] == Decimal("20.00")
    # orphan product excluded from spend
    top = R.top_customers(t).collect()
    assert top[0]["transaction_count"] == 1


def test_duplicate_merge_source_fails(spark):
    t = basic(spark)
    dup = spark.createDataFrame([(2, "SILVER"), (2, "BRONZE")], "customer_id bigint, new_tier string")
    with pytest.raises(Exception, match="more than one source row acts"):
        T.apply_tier_changes(t, dup).collect()


def test_ties_break_on_customer_id(spark):
    customers = [(i, f"c{i}", "GOLD", D) for i in (5, 3, 4)]
    products = [(1, "p", "Home", price(100))]
    txns = [(i, c, 1, 1, D) for i, c in enumerate((5, 3, 4))]
    t = star(spark, customers, products, txns)
    top = [r["customer_id"] for r in R.top_customers(t, 2).collect()]
    assert top == [3, 4]


def test_missing_tier_is_skipped(spark):
    customers = [(1, "a", "SILVER", D)]
    products = [(1, "p", "Home", price(1500))]
    t = star(spark, customers, products, [(1, 1, 1, 1, D)])
    band = {r["check_item"]: r["status"] for r in Q.tier_band_check(t).collect()}
    assert band["GOLD min spend >= 3000"] == "SKIPPED"
    assert band["SILVER min spend >= 1000"] == "PASS"
    assert band["SILVER max spend < 3000"] == "PASS"


def test_report_computes_status(spark):
    t = basic(spark)
    rep = {(r["Check_Category"], r["Check_Item"]): r for r in Q.validation_report(
        t, {"products": 49, "customers": 6, "sales_transactions": 5}).collect()}
    assert rep[("Data Volume Check", "Products")]["Status"] == "FAIL"
    assert rep[("Data Volume Check", "Customers")]["Status"] == "PASS"
    assert rep[("Tier Assignment", "All Tiers")]["Status"] == "FAIL"
    assert rep[("Referential Integrity", "Customer FK")]["Status"] == "PASS"


def test_tier_stats_half_up(spark):
    customers = [(1, "a", "GOLD", D), (2, "b", "GOLD", D), (3, "c", "GOLD", D)]
    products = [(1, "p", "Home", price(1.00)), (2, "q", "Home", price(1.01))]
    t = star(spark, customers, products, [(1, 1, 1, 1, D), (2, 2, 2, 1, D)])
    st = rows(R.tier_stats(t), "segment")["GOLD"]
    assert st["customer_count"] == 3 and st["avg_spend"] == Decimal("1.01")
    assert st["total_revenue"] == Decimal("2.01")


def test_duplicate_product_rows_match_row_join_sql(spark):
    """Price sums per product give the row join's sums and distinct counts."""
    customers = [(1, "a", "GOLD", D), (2, "b", "SILVER", D)]
    products = [(1, "p", "Home", price(10)), (1, "p", "Home", price(12)), (1, "p", "Home", None),
                (1, "p", "Toys", price(5)), (2, "q", "Home", price(7))]
    txns = [(1, 1, 1, 2, D), (2, 1, 2, 1, D), (3, 2, 1, 3, D), (4, 2, 9, 1, D)]
    for unique in (False, True):
        t = replace(star(spark, customers, products, txns), unique_txn_id=unique)
        t.customers.createOrReplaceTempView("c")
        t.products.createOrReplaceTempView("p")
        t.transactions.createOrReplaceTempView("t")
        exp_top = {r[0]: (r[1], r[2]) for r in spark.sql(
            "SELECT c.customer_id, CAST(SUM(p.unit_price * t.quantity) AS DECIMAL(38,2)), COUNT(DISTINCT t.txn_id) "
            "FROM c JOIN t ON c.customer_id = t.customer_id JOIN p ON t.product_id = p.product_id "
            "GROUP BY c.customer_id").collect()}
        got_top = {r.customer_id: (r.total_spend, r.transaction_count) for r in R.top_customers(t).collect()}
        assert got_top == exp_top
        exp_cat = {r[0]: (r[1], r[2], r[3]) for r in spark.sql(
            "SELECT p.category, COUNT(DISTINCT t.txn_id), CAST(SUM(p.unit_price * t.quantity) AS DECIMAL(38,2)), "
            "CAST(ROUND(SUM(p.unit_price * t.quantity) / COUNT(p.unit_price * t.quantity), 2) AS DECIMAL(38,2)) "
            "FROM t JOIN p ON t.product_id = p.product_id GROUP BY p.category").collect()}
        got_cat = {r.category: (r.transaction_count, r.total_revenue, r.avg_transaction_value)
                   for r in R.revenue_by_category(t).collect()}
        assert got_cat == exp_cat


def test_top_n_per_tier_beyond_group_limit_threshold(spark):
    from tierwise.sources.model import from_tpch

    t = from_tpch(spark, "/root/testdata/sf0.001")
    a = sorted(tuple(r) for r in R.top_n_per_tier(t, 5).collect())
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "3")
    try:
        b = sorted(tuple(r) for r in R.top_n_per_tier(t, 5).collect())
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")
    assert a == b and len(a) == 15


def test_verified_txn_key(spark):
    from tierwise.operators.quality import with_verified_txn_key

    t = basic(spark)
    assert with_verified_txn_key(t).unique_txn_id is True
    dup = star(spark, [(1, "a", "GOLD", D)], [(1, "p", "Home", price(10))], [(7, 1, 1, 1, D), (7, 1, 1, 2, D)])
    v = with_verified_txn_key(dup)
    assert v.unique_txn_id is False
    assert R.top_customers(v).first()["transaction_count"] == 1  # exact distinct kept


def test_date_spine_fills_days_and_counts_product_rows(spark):
    from tierwise.operators import windows as W

    customers = [(1, "a", "GOLD", D)]
    products = [(1, "p", "Home", price(10)), (1, "p", "Home", price(12)), (2, "q", "Home", price(7))]
    d2 = D.replace(day=3)
    txns = [(1, 1, 1, 2, D), (2, 1, 2, 1, D), (3, 1, 1, 3, d2), (4, 1, 9, 1, d2)]
    a = sorted(tuple(r) for r in W.date_spine_revenue(star(spark, customers, products, txns)).collect())
    assert [r[1:] for r in a] == [(price(51), 3), (price(0), 0), (price(66), 2)]


def test_transaction_details_skips_orphans_exactly(spark):
    from tierwise.operators.spend import transaction_details

    customers = [(1, "a", "GOLD", D), (2, "b", "GOLD", D)]
    products = [(1, "p", "Home", price(10))]
    # the first ten transactions are orphans; the answer lies beyond them
    txns = [(i, 99, 1, 1, D) for i in range(1, 11)] + [(i, 1 + i % 2, 1, i % 5 + 1, D) for i in range(11, 40)]
    t = star(spark, customers, products, txns)
    got = [r.txn_id for r in transaction_details(t, 5).collect()]
    assert got == [11, 12, 13, 14, 15]
    assert [r.txn_id for r in transaction_details(t, 100).collect()] == list(range(11, 40))


def test_spend_same_with_and_without_pair_reduction(spark):
    from tierwise.operators.spend import customer_spend, spend_and_count_by_customer

    customers = [(1, "a", "GOLD", D), (2, "b", "SILVER", D)]
    products = [(1, "p", "Home", price(10)), (1, "p", "Home", price(12)), (2, "q", "Home", price(7))]
    txns = [(1, 1, 1, 2, D), (2, 1, 1, 1, D), (3, 2, 1, 3, D), (4, 2, 9, 1, D), (5, 1, 2, None, D)]
    t = star(spark, customers, products, txns)
    a = sorted(tuple(r) for r in customer_spend(t).collect())
    assert a == sorted(tuple(r) for r in customer_spend(t, eager=True).collect()) == [(1, price(66)), (2, price(66))]
    for unique in (False, True):
        rows = spend_and_count_by_customer(replace(t, unique_txn_id=unique)).collect()
        assert sorted(tuple(r) for r in rows) == [(1, price(66), 3), (2, price(66), 1)]


def test_transaction_details_same_with_a_declared_key(spark):
    from tierwise.operators.spend import transaction_details

    customers = [(1, "a", "GOLD", D), (2, "b", "GOLD", D)]
    products = [(1, "p", "Home", price(10)), (2, "q", "Toys", price(3))]
    txns = [(i, 99 if i % 3 else 1, 1, 1, D) for i in range(1, 11)] + [(i, 1 + i % 2, 1 + i % 4, 2, D) for i in range(11, 40)]
    t = star(spark, customers, products, txns)
    plain = [tuple(r) for r in transaction_details(t, 7).collect()]
    assert plain == [tuple(r) for r in transaction_details(replace(t, unique_txn_id=True), 7).collect()] and len(plain) == 7


def test_process_tiers(spark):
    t = basic(spark)
    new, changes = T.process_tiers(t)
    assert {(r.customer_id, r.new_tier) for r in changes.collect()} == {(2, "SILVER"), (3, "GOLD"), (6, "BRONZE")}
    held = {r.customer_id: r.segment for r in new.collect()}
    assert held == {1: "GOLD", 2: "SILVER", 3: "GOLD", 4: "GOLD", 5: None, 6: "BRONZE"}
    assert T.tier_changes(t.with_customers(new)).count() == 0


def test_an_order_of_more_than_a_thousand_lines_keeps_its_count(spark, scratch):
    """txn_id stays unique, and counts agree with COUNT(DISTINCT)."""
    from tierwise.sources.model import from_tpch

    src = "/root/testdata/sf0.001"
    for name in ("customer", "part"):
        spark.read.parquet(f"{src}/{name}.parquet").write.parquet(f"{scratch}/{name}.parquet")
    orders = spark.read.parquet(f"{src}/orders.parquet").limit(1)
    line = spark.read.parquet(f"{src}/lineitem.parquet").limit(1)
    two = [orders.withColumn("o_orderkey", F.lit(k).cast("long")).withColumn("o_custkey", F.lit(c).cast("long")) for k, c in ((10, 1), (11, 2))]
    two[0].union(two[1]).write.parquet(f"{scratch}/orders.parquet")
    ten = line.withColumn("l_orderkey", F.lit(10).cast("long")).crossJoin(spark.range(1001)).drop("id")
    ten.union(line.withColumn("l_orderkey", F.lit(11).cast("long"))).write.parquet(f"{scratch}/lineitem.parquet")
    t = from_tpch(spark, scratch)
    ids = t.numbered()
    assert ids.count() == ids.select("txn_id").distinct().count() == 1002
    assert {r.customer_id: r.transaction_count for r in R.top_customers(t).collect()} == {1: 1001, 2: 1}
    assert R.revenue_by_category(t).first().transaction_count == 1002


def test_queries_see_appended_rows_and_lost_lines_fail(spark, scratch):
    import __spark_entry__ as E

    src = "/root/testdata/sf0.001"
    for name in ("customer", "part", "orders", "lineitem"):
        spark.read.parquet(f"{src}/{name}.parquet").write.parquet(f"{scratch}/{name}.parquet")
    count = lambda: {r.table_name: r.row_count for r in E.queries()["scan_counts"](spark, scratch).collect()}
    before = count()["sales_transactions"]
    lines = spark.read.parquet(f"{src}/lineitem.parquet")
    lines.write.mode("append").parquet(f"{scratch}/lineitem.parquet")
    assert count()["sales_transactions"] == 2 * before
    status = lambda: {r.table_name: r.status for r in E.queries()["volume_check"](spark, scratch).collect()}
    assert set(status().values()) == {"PASS"}
    lines.limit(1).withColumn("l_orderkey", F.lit(-5).cast("long")).write.mode("append").parquet(f"{scratch}/lineitem.parquet")
    assert status()["sales_transactions"] == "FAIL"  # a line without an order


def test_one_scan_profile_equals_the_single_checks(spark):
    """Duplicate customer ids (also under other names), customers without an
    id, unknown and NULL foreign keys: the one-scan profile agrees with every
    check run by itself."""
    customers = [(1, "a", "GOLD", D), (1, "a", "GOLD", D), (1, "b", "SILVER", D), (2, "c", "SILVER", D), (2, None, None, D),
                 (3, "d", "BRONZE", D), (None, "e", "GOLD", D), (None, "f", "GOLD", D), (None, "f", "GOLD", D)]
    products = [(1, "p", "Home", price(1000)), (1, "p2", "Home", price(500)), (2, "q", "Home", None), (None, "r", "Home", price(1))]
    txns = [(1, 1, 1, 1, D), (2, 1, 9, 1, D), (3, 2, 1, 1, D), (4, 7, 1, 2, D), (5, None, 1, 1, D), (6, None, None, 1, D),
            (7, 3, 2, 4, D), (8, 3, None, 1, D)]
    for c, p, x in [(customers, products, txns), (customers, products, []), ([], products, txns), (customers, [], txns), ([], [], [])]:
        t = star(spark, c, p, x)
        got = Q.fact_profile(t).first()
        single = {r["table_name"]: r["row_count"] for r in Q.scan_counts(t).collect()}
        verdicts = [r["validation_result"] for r in Q.validate_tiers(t).collect()]
        assert (got.customers, got.transactions) == (single["customers"], single["sales_transactions"])
        assert got.orphaned_customers == Q.orphan_customers(t).first()[0]
        assert got.orphaned_products == Q.orphan_products(t).first()[0]
        assert (got.tiers_passed, got.tiers_checked) == (verdicts.count("PASS"), len(verdicts))

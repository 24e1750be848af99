"""Data-quality and validation set.

Every check is a DataFrame (nothing is collected); statuses are computed,
never hardcoded.  ``validation_report`` unions the checks into one
string-typed PASS/FAIL table.

Scale notes: the orphan checks pre-aggregate the fact table by foreign key
before the anti join, so only distinct keys are shuffled; the null checks
read each table once (one aggregate per table) instead of once per column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierwise.functions.money import money
from tierwise.operators.reports import spending_ranges
from tierwise.operators.spend import spend_by_customer
from tierwise.schemas import REPORT, conform
from tierwise.sources.model import Tables


def _status(ok: Column) -> Column:
    return F.when(ok, F.lit("PASS")).otherwise(F.lit("FAIL"))


# -- V1 volumes ---------------------------------------------------------------


def scan_counts(t: Tables) -> DataFrame:
    """table_name, row_count for the three tables: plain counts, no keys."""
    frames = {"customers": t.customers, "products": t.products, "sales_transactions": t.transactions}
    counts = [df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count")) for name, df in frames.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


def _expected_counts(t: Tables, expected: dict[str, int] | None) -> DataFrame:
    spark = t.spark
    if expected is not None:
        return spark.createDataFrame([(k, int(v)) for k, v in expected.items()], "table_name string, expected bigint")
    out = None
    for name, df in t.source_counts.items():
        d = df.select(F.lit(name).alias("table_name"), F.col("n").cast("bigint").alias("expected"))
        out = d if out is None else out.unionByName(d)
    if out is None:  # nothing to compare with: every volume check fails
        out = spark.createDataFrame([], "table_name string, expected bigint")
    return out


def volume_check(t: Tables, expected: dict[str, int] | None = None) -> DataFrame:
    """table_name, actual, expected, status.  ``expected`` defaults to the
    plain row counts of the source tables, so a row that the view layer loses
    or repeats fails the check."""
    exp = _expected_counts(t, expected)
    return (
        scan_counts(t)
        .join(exp, "table_name", "left")
        .select(
            "table_name", F.col("row_count").alias("actual"), "expected",
            _status(F.coalesce(F.col("row_count") == F.col("expected"), F.lit(False))).alias("status"),
        )
    )


# -- V2 tier assignment --------------------------------------------------------


def _customers_left_spend(t: Tables, keys: tuple[str, ...]) -> DataFrame:
    """customers LEFT JOIN transactions LEFT JOIN products GROUP BY ``keys``,
    computed aggregate-first: the per-customer spend is joined to the
    customer rows, so a duplicated customer row counts its spend per copy."""
    return (
        t.customers.select(*keys)
        .join(spend_by_customer(t), "customer_id", "left")
        .groupBy(*keys)
        .agg(F.sum("total_spend").alias("total_spend"))
    )


def validate_tiers(t: Tables) -> DataFrame:
    """customer_id, cust_name, assigned_tier, total_spend, expected_tier,
    validation_result (PASS when segment = expected tier; NULL -> FAIL)."""
    g = _customers_left_spend(t, ("customer_id", "cust_name", "segment"))
    expected = t.rules.tier_of(F.col("total_spend"))
    return g.select(
        "customer_id",
        "cust_name",
        F.col("segment").alias("assigned_tier"),
        money("total_spend").alias("total_spend"),
        expected.alias("expected_tier"),
        _status(F.coalesce(F.col("segment") == expected, F.lit(False))).alias("validation_result"),
    )


def validate_tiers_summary(t: Tables) -> DataFrame:
    """validation_result, count."""
    return validate_tiers(t).groupBy("validation_result").agg(F.count(F.lit(1)).alias("count"))


def tier_mismatches(t: Tables) -> DataFrame:
    """customer_id, segment, total_spend, expected_segment - customers whose
    segment differs from the tier of COALESCE(spend, 0)."""
    g = _customers_left_spend(t, ("customer_id", "segment"))
    spend = F.coalesce(F.col("total_spend"), F.lit(0).cast("decimal(38,2)"))
    expected = t.rules.tier_of(spend)
    return g.where(F.col("segment") != expected).select(
        "customer_id", "segment", money(spend).alias("total_spend"), expected.alias("expected_segment")
    )


# -- V3 bands --------------------------------------------------------------------


def tier_band_check(t: Tables) -> DataFrame:
    """check_item, actual, bound, status - every tier's min spend at or above
    its threshold and max spend below the next one.  A tier with no spend
    value is SKIPPED (zero is a value and is checked).  One pass over the
    spending ranges; the rule rows come from the tier rules."""
    checks = []
    for tier in t.rules.tiers:
        low, high = t.rules.band(tier)
        if low is not None:
            checks.append((f"{tier} min spend >= {low}", tier, "min", low))
        if high is not None:
            checks.append((f"{tier} max spend < {high}", tier, "max", high))
    rules = t.spark.createDataFrame(checks, "check_item string, tier string, kind string, bound decimal(38,2)")
    ranges = spending_ranges(t, ordered=False).select("segment", "min_spend", "max_spend")
    j = rules.join(ranges, rules["tier"] == ranges["segment"], "left")
    actual = F.when(F.col("kind") == "min", F.col("min_spend")).otherwise(F.col("max_spend"))
    ok = F.when(F.col("kind") == "min", actual >= F.col("bound")).otherwise(actual < F.col("bound"))
    return j.select(
        "check_item",
        money(actual).alias("actual"),
        F.col("bound"),
        F.when(actual.isNull(), F.lit("SKIPPED")).when(ok, F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status"),
    )


# -- V4 nulls ------------------------------------------------------------------------

# The columns the reference checks for NULL, by table.
NULL_CHECK_COLUMNS = {
    "customers": ("customer_id", "cust_name", "segment"),
    "products": ("product_id", "unit_price"),
    "sales_transactions": ("txn_id", "customer_id", "product_id"),
}


def null_checks(t: Tables, columns: dict[str, tuple[str, ...]] = NULL_CHECK_COLUMNS) -> DataFrame:
    """table, column, null_count, status - one aggregate per table.  A
    ``txn_id`` that has to be built is a row number, so it has no NULL and
    isn't built for the check."""
    frames = {"customers": t.customers, "products": t.products, "sales_transactions": t.transactions}
    out = None
    for table, cols in columns.items():
        own = frames[table].columns
        agg = frames[table].agg(*[F.count_if(F.col(c).isNull() if c in own else F.lit(False)).alias(c) for c in cols])
        long = agg.unpivot([], list(cols), "column", "null_count").select(
            F.lit(table).alias("table"), "column", "null_count", _status(F.col("null_count") == 0).alias("status")
        )
        out = long if out is None else out.unionByName(long)
    return out


def null_profile(t: Tables) -> DataFrame:
    """table_name, null_customer_ids, null_names, null_segments."""
    return t.customers.agg(
        F.lit("customers").alias("table_name"),
        F.count_if(F.col("customer_id").isNull()).alias("null_customer_ids"),
        F.count_if(F.col("cust_name").isNull()).alias("null_names"),
        F.count_if(F.col("segment").isNull()).alias("null_segments"),
    )


# -- V5 referential integrity --------------------------------------------------------


def orphan_count(facts: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """orphaned_count: fact rows whose ``key`` has no dimension row (NULL
    keys included).  Facts are counted per key before the anti join, so one
    row per key and partition is shuffled."""
    per_key = facts.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return (
        per_key.join(dim.select(key).where(F.col(key).isNotNull()), key, "left_anti")
        .agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("orphaned_count"))
    )


def orphan_customers(t: Tables) -> DataFrame:
    return orphan_count(t.transactions, t.customers, "customer_id")


def orphan_products(t: Tables) -> DataFrame:
    return orphan_count(t.transactions, t.products, "product_id")


# -- V6 duplicates, V7 rule violations, V12 conservation ----------------------------


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """key, cnt for keys present more than once."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("cnt")).where(F.col("cnt") > 1)


def with_verified_txn_key(t: Tables) -> Tables:
    """The primary-key check on ``txn_id`` (no value twice, no NULL); when it
    holds, the bundle declares the key so that transaction counts need no
    distinct aggregation.  One aggregate over the fact, paid once for all the
    reports that follow."""
    from dataclasses import replace

    ids = t.numbered().groupBy("txn_id").agg(F.count(F.lit(1)).alias("cnt"))
    return replace(t, unique_txn_id=ids.where((F.col("cnt") > 1) | F.col("txn_id").isNull()).isEmpty())


def duplicate_customers(t: Tables) -> DataFrame:
    return duplicate_keys(t.customers, "customer_id")


def gold_violations(t: Tables) -> DataFrame:
    """violation_count: customers in the top tier whose spend is below its
    threshold (inner join: customers without spend are not counted)."""
    tier, minimum = t.rules.thresholds[0]
    top = t.customers.where(F.col("segment") == F.lit(tier)).select("customer_id")
    return (
        top.join(spend_by_customer(t), "customer_id", "inner")
        .where(F.col("total_spend") < F.lit(minimum))
        .agg(F.count(F.lit(1)).alias("violation_count"))
    )


def tier_total_check(t: Tables) -> DataFrame:
    """tier_total, customer_total, status: customers in some tier add up to
    all customers (fails when segments are NULL or unknown)."""
    tiers = t.rules.tiers
    return t.customers.agg(
        F.count_if(F.col("segment").isin(tiers)).alias("tier_total"),
        F.count(F.lit(1)).alias("customer_total"),
    ).select("tier_total", "customer_total", _status(F.col("tier_total") == F.col("customer_total")).alias("status"))


# -- V9 report ----------------------------------------------------------------------------

# The report's category and item labels.
REPORT_VOLUME = "Data Volume Check"
REPORT_TIERS = "Tier Assignment"
REPORT_REFERENCES = "Referential Integrity"
REPORT_TABLE_ITEMS = {"products": "Products", "customers": "Customers", "sales_transactions": "Transactions"}
REPORT_ALL_TIERS = "All Tiers"
REPORT_CUSTOMER_FK = "Customer FK"
REPORT_PRODUCT_FK = "Product FK"


def fact_profile(t: Tables) -> DataFrame:
    """One row: customers, transactions (row counts), orphaned_customers,
    orphaned_products, tiers_passed, tiers_checked - every check that reads
    the fact, from one scan of it.

    A line joined to the product prices says what it costs and whether its
    product exists; one aggregate by customer adds that up.  These rows meet
    the customers in a full outer join: a row without a customer is made of
    orphans, a customer without a row has no spend.  A customer_id with several
    customer rows repeats the fact's row, of which only the first counts for
    the fact."""
    lost = F.col("_rows").isNull()  # the product is unknown
    buyers = (
        t.transactions.select("customer_id", "product_id", "quantity")
        .join(t.product_prices(), "product_id", "left")
        .groupBy("customer_id")
        .agg(
            F.count(F.lit(1)).alias("lines"), F.count_if(lost).alias("lost"),
            F.sum(F.col("unit_price") * F.col("quantity")).alias("spend"),
        )
    )
    held = t.customers.groupBy("customer_id", "cust_name", "segment").agg(F.count(F.lit(1)).alias("copies"))
    # customers without an id join nothing and don't gather in one group
    lone = F.when(F.col("customer_id").isNull(), F.xxhash64("cust_name", "segment"))
    number = F.row_number().over(Window.partitionBy("customer_id", lone).orderBy("cust_name", "segment"))
    held = held.withColumn("number", number)
    both = held.alias("c").join(buyers.alias("b"), F.col("c.customer_id") == F.col("b.customer_id"), "full_outer")
    known = F.col("c.copies").isNotNull()
    counts = ~known | (F.col("c.number") == 1)
    expected = t.rules.tier_of(F.col("b.spend") * F.col("c.copies"))

    def total(value: Column, where: Column) -> Column:
        return F.coalesce(F.sum(F.when(where, value)), F.lit(0)).cast("bigint")

    return both.agg(
        total(F.col("c.copies"), known).alias("customers"),
        total(F.col("b.lines"), counts).alias("transactions"),
        total(F.col("b.lines"), ~known).alias("orphaned_customers"),
        total(F.col("b.lost"), counts).alias("orphaned_products"),
        F.count_if(known & (F.col("c.segment") == expected)).alias("tiers_passed"),
        F.count_if(known).alias("tiers_checked"),
    )


def validation_report(t: Tables, expected: dict[str, int] | None = None) -> DataFrame:
    """Check_Category, Check_Item, Actual, Expected, Status (all strings).

    ``fact_profile`` gives all counts over the fact at once.  The expected row
    counts come from elsewhere (``expected``, or the source files' own row
    counts, which reads none of their columns)."""
    def row(category: str, item: str, actual: Column, wanted: Column, table: str | None = None) -> Column:
        values = {"Check_Category": F.lit(category), "Check_Item": F.lit(item), "actual": actual, "wanted": wanted, "table_name": F.lit(table)}
        return F.struct(*[v.cast("bigint" if k in ("actual", "wanted") else "string").alias(k) for k, v in values.items()])

    def volume(table: str, actual: Column) -> Column:
        return row(REPORT_VOLUME, REPORT_TABLE_ITEMS[table], actual, F.lit(None), table)

    checks = fact_profile(t).select(F.explode(F.array(
        volume("customers", F.col("customers")),
        volume("sales_transactions", F.col("transactions")),
        row(REPORT_TIERS, REPORT_ALL_TIERS, F.col("tiers_passed"), F.col("tiers_checked")),
        row(REPORT_REFERENCES, REPORT_CUSTOMER_FK, F.col("orphaned_customers"), F.lit(0)),
        row(REPORT_REFERENCES, REPORT_PRODUCT_FK, F.col("orphaned_products"), F.lit(0)),
    )).alias("r"))
    checks = checks.unionByName(t.products.agg(F.count(F.lit(1)).alias("n")).select(volume("products", F.col("n")).alias("r")))
    rows = checks.select("r.*").join(_expected_counts(t, expected), "table_name", "left")
    wanted = F.coalesce("wanted", "expected")
    return conform(
        rows.select(
            "Check_Category", "Check_Item", F.col("actual").cast("string").alias("Actual"), wanted.cast("string").alias("Expected"),
            _status(F.coalesce(F.col("actual") == wanted, F.lit(False))).alias("Status"),
        ),
        REPORT,
    )


def check_constraint(df: DataFrame, name: str, condition: Column) -> DataFrame:
    """constraint_name, violations: rows where ``condition`` is false (a
    NULL result passes, as CHECK constraints do)."""
    return df.agg(
        F.lit(name).alias("constraint_name"),
        F.count_if(~F.coalesce(condition, F.lit(True))).alias("violations"),
    )


def check_constraints(t: Tables) -> DataFrame:
    """The star's CHECK-style rules: positive quantity, non-negative price."""
    return check_constraint(t.transactions, "quantity_positive", F.col("quantity") > 0).unionByName(
        check_constraint(t.products, "unit_price_non_negative", F.col("unit_price") >= 0)
    )

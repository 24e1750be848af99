"""Documented extras: MERGE variants, ranking and gaps, date spine,
correlated comparison, scalar functions, surrogate keys, table compare
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tierwise.functions.money import money
from tierwise.functions.scalar import code_of, date_functions, sql_code_of, string_functions, with_default
from tierwise.operators import tiers as T
from tierwise.operators import windows as W
from tierwise.operators.compare import compare_columns, compare_tables
from tierwise.operators.merge import WhenMatched, WhenNotMatched, delete_where, merge, merge_metrics, merged_rows
from tierwise.operators.ordered import global_row_number
from tierwise.plans.oracle_views import (
    EARNED,
    PRICE,
    RULES,
    SPENDING,
    UPDATED,
    money_sql,
    with_views,
)
from tierwise.plans.registry import query

AS_OF = dt.date(2001, 8, 1)
SNAPSHOT_DAYS = 500  # upsert target: customers who signed up over 500 days before as_of
INACTIVE_DAYS = 365  # delete: customers without transactions, signed up over a year ago


# -- MERGE variants -------------------------------------------------------------


def _upsert_tagged(t):
    snapshot = t.customers.where(F.col("signup_date") < F.lit(AS_OF - dt.timedelta(days=SNAPSHOT_DAYS)))
    source = T.customer_tiers(t).join(t.customers.select("customer_id", "cust_name", "signup_date"), "customer_id")
    return merge(
        snapshot,
        source.select("customer_id", "cust_name", "new_tier", "signup_date"),
        "customer_id",
        matched=[WhenMatched(update={"segment": F.col("s.new_tier")}, condition=F.col("t.segment") != F.col("s.new_tier"))],
        not_matched=WhenNotMatched(
            values={
                "customer_id": F.col("s.customer_id"),
                "cust_name": F.col("s.cust_name"),
                "segment": F.col("s.new_tier"),
                "signup_date": F.col("s.signup_date"),
            }
        ),
    )


# every customer id that either side knows, with both sides' tiers
_UPSERT = (
    *SPENDING, EARNED,
    f"""older AS (FROM customers WHERE signup_date < DATE '{AS_OF}' - {SNAPSHOT_DAYS})""",
    """outcome AS (
  SELECT everyone.customer_id, everyone.cust_name, everyone.signup_date,
         CASE WHEN older.customer_id IS NULL THEN 'insert' WHEN older.segment <> tier THEN 'update' ELSE 'keep' END AS action,
         CASE WHEN older.customer_id IS NULL OR older.segment <> tier THEN tier ELSE older.segment END AS segment
  FROM customers everyone LEFT JOIN older USING (customer_id) LEFT JOIN earned USING (customer_id)
  WHERE older.customer_id IS NOT NULL OR tier IS NOT NULL)""",
)


@query("merge_upsert", with_views("SELECT customer_id, cust_name, segment, signup_date FROM outcome", *_UPSERT))
def merge_upsert(t):
    """Upsert the computed tiers into an older customer snapshot: update
    when the tier differs, insert customers the snapshot lacks."""
    return merged_rows(_upsert_tagged(t))


@query("merge_metrics", with_views("SELECT action, COUNT(*) AS row_count FROM outcome GROUP BY ALL", *_UPSERT))
def merge_metrics_q(t):
    return merge_metrics(_upsert_tagged(t))


@query("merge_delete", with_views(
    f"""FROM customers
WHERE signup_date >= DATE '{AS_OF}' - {INACTIVE_DAYS} OR customer_id IN (SELECT customer_id FROM sales_transactions)"""))
def merge_delete(t):
    """MERGE ... WHEN MATCHED AND signup is old THEN DELETE, the source
    being customers without transactions."""
    inactive = t.customers.select("customer_id").join(
        t.transactions.select("customer_id").distinct(), "customer_id", "left_anti"
    )
    cutoff = F.lit(AS_OF - dt.timedelta(days=INACTIVE_DAYS))
    return merged_rows(
        merge(t.customers, inactive, "customer_id",
              matched=[WhenMatched(delete=True, condition=F.col("t.signup_date") < cutoff)])
    )


@query("delete_where", with_views(
    f"""SELECT customer_id, cust_name, segment, signup_date FROM customers
WHERE NOT COALESCE(segment = '{RULES.default_tier}', FALSE)"""))
def delete_where_q(t):
    """DELETE FROM customers WHERE segment = <default tier>."""
    return delete_where(t.customers, F.col("segment") == F.lit(RULES.default_tier))


@query("compare_tables", with_views(
    """SELECT IF(moved.customer_id IS NULL OR segment IS NULL, 'same', 'changed') AS status, COUNT(*) AS row_count
FROM customers LEFT JOIN moved USING (customer_id) GROUP BY ALL""", *UPDATED))
def compare_tables_q(t):
    """Customers before vs after the tier update, per-row status counts."""
    return compare_tables(t.customers, _after_update(t), "customer_id")


def _after_update(t):
    """The updated customers, stored: a comparison reads them twice."""
    return T.process_tiers(t)[0].checkpoint()


@query("compare_columns", with_views(
    """SELECT name AS "column", COALESCE(MAX(n), 0) AS changed, 0::BIGINT AS became_null, 0::BIGINT AS was_null
FROM (VALUES ('cust_name'), ('segment'), ('signup_date')) names(name)
LEFT JOIN (SELECT 'segment' AS name, COUNT(*) AS n FROM customers JOIN moved USING (customer_id) WHERE segment IS NOT NULL) found USING (name)
GROUP BY ALL""", *UPDATED))
def compare_columns_q(t):
    """Which columns the tier update changes, and in how many rows."""
    return compare_columns(t.customers, _after_update(t), "customer_id")


# -- windows, spine, correlated subquery ------------------------------------------


@query("product_rank", with_views(
    f"""SELECT category, product_id, product_name, revenue,
       (SELECT COUNT(*) FROM earning better WHERE better.category = earning.category AND better.revenue > earning.revenue) + 1 AS revenue_rank
FROM earning""",
    f"""earning AS (
  SELECT category, product_id, product_name, {money_sql('SUM(unit_price) * ANY_VALUE(units)')} AS revenue
  FROM products JOIN (SELECT product_id, SUM(quantity) AS units FROM sales_transactions GROUP BY product_id) sold USING (product_id)
  GROUP BY ALL)"""))
def product_rank(t):
    return W.product_rank(t)


@query("days_between_txns", with_views(
    """SELECT customer_id, txn_id, txn_date,
       LAG(txn_date) OVER (PARTITION BY customer_id ORDER BY txn_date, txn_id) AS prev_txn_date,
       CAST(txn_date - LAG(txn_date) OVER (PARTITION BY customer_id ORDER BY txn_date, txn_id) AS INTEGER) AS days_since_prev
FROM sales_transactions"""))
def days_between_txns(t):
    return W.days_between_txns(t)


@query("date_spine_revenue", with_views(
    f"""SELECT day AS txn_date, {money_sql('COALESCE(SUM(quantity * per_unit), 0)')} AS revenue,
       CAST(COALESCE(SUM(product_rows), 0) AS BIGINT) AS txn_count
FROM (SELECT CAST(UNNEST(generate_series(MIN(txn_date), MAX(txn_date), INTERVAL 1 DAY)) AS DATE) AS day FROM sales_transactions) days
LEFT JOIN (sales_transactions JOIN price USING (product_id)) ON txn_date = day
GROUP BY day""", PRICE))
def date_spine_revenue(t):
    return W.date_spine_revenue(t)


@query("above_category_avg", with_views(
    """SELECT product_id, product_name, category, unit_price FROM products
WINDOW same_kind AS (PARTITION BY category)
QUALIFY unit_price * COUNT(unit_price) OVER same_kind > SUM(unit_price) OVER same_kind"""))
def above_category_avg(t):
    return W.above_category_avg(t)


# -- scalar functions, keys, defaults ------------------------------------------------


@query("gen_codes", with_views(f"SELECT customer_id, {sql_code_of('customer_id')} AS code FROM customers"))
def gen_codes(t):
    """A deterministic 8-letter code per customer."""
    return t.customers.select("customer_id", code_of(F.col("customer_id")).alias("code"))


@query("string_functions", with_views(
    r"""SELECT customer_id, upper(cust_name) AS name_upper, lower(cust_name) AS name_lower,
       CAST(length(cust_name) AS INTEGER) AS name_length, substring(cust_name, 1, 8) AS name_prefix,
       regexp_extract(cust_name, '([0-9]+)$', 1) AS name_number, CAST(instr(cust_name, '#') AS INTEGER) AS hash_pos,
       trim(concat('  ', cust_name, '  ')) AS name_trimmed
FROM customers"""))
def string_functions_q(t):
    return string_functions(t.customers)


_A = f"DATE '{AS_OF}'"
_WHOLE_MONTHS = (
    f"CAST((year({_A}) * 12 + month({_A})) - (year(signup_date) * 12 + month(signup_date)) "
    f"- CASE WHEN day({_A}) = day(signup_date) OR ({_A} = last_day({_A}) AND signup_date = last_day(signup_date)) THEN 0 "
    f"WHEN day({_A}) < day(signup_date) THEN 1 ELSE 0 END AS INTEGER)"
)


# (day offsets as integer arithmetic: DuckDB treats INTERVAL 30 DAY and
# INTERVAL 1 MONTH as equal and would merge the two expressions)
@query("date_functions", with_views(
    f"""SELECT customer_id, signup_date,
       CAST(signup_date + 30 AS DATE) AS plus_30_days,
       CAST(signup_date - 7 AS DATE) AS minus_7_days,
       CAST({_A} - signup_date AS INTEGER) AS days_since_signup,
       {_WHOLE_MONTHS} AS whole_months_since_signup,
       CAST(date_trunc('month', signup_date) AS DATE) AS signup_month,
       last_day(signup_date) AS signup_month_end,
       CAST(signup_date + INTERVAL 1 MONTH AS DATE) AS plus_one_month
FROM customers"""))
def date_functions_q(t):
    return date_functions(t.customers, AS_OF)


@query("default_segment", with_views(
    f"SELECT customer_id, COALESCE(segment, '{RULES.default_tier}') AS segment FROM customers"))
def default_segment(t):
    return with_default(t.customers.select("customer_id", "segment"), "segment", RULES.default_tier)


@query("assign_surrogate_key", with_views(
    "SELECT txn_id, txn_date, ROW_NUMBER() OVER (ORDER BY txn_date, txn_id) AS row_num FROM sales_transactions"))
def assign_surrogate_key(t):
    """Consecutive keys 1..n over (txn_date, txn_id), computed without a
    single-partition window."""
    return global_row_number(t.numbered().select("txn_id", "txn_date"), ["txn_date", "txn_id"], "row_num")


@query("customer_spend_eager", with_views(
    f"SELECT customer_id, {money_sql('SUM(units * per_unit)')} AS total_spend "
    "FROM (SELECT customer_id, product_id, SUM(quantity) AS units FROM sales_transactions GROUP BY ALL) pairs "
    "JOIN price USING (product_id) WHERE customer_id IN (SELECT customer_id FROM customers) GROUP BY customer_id", PRICE))
def customer_spend_eager(t):
    """customer_spend with the fact reduced to (customer, product) pairs
    before the product join; the result is the same."""
    from tierwise.operators.spend import customer_spend

    return customer_spend(t, eager=True).select("customer_id", money("total_spend").alias("total_spend"))


# -- table metadata ------------------------------------------------------------------


@query("table_detail", """SELECT 'customer' AS table_name, COUNT(*) AS num_rows FROM customer
UNION ALL SELECT 'part', COUNT(*) FROM part
UNION ALL SELECT 'orders', COUNT(*) FROM orders
UNION ALL SELECT 'lineitem', COUNT(*) FROM lineitem""")
def table_detail_q(t):
    """table_name, num_rows of the source tables the star is read from; the
    files and bytes that ``catalog.table_detail`` also gives differ from copy
    to copy of a table, so they are left to the tests."""
    from tierwise.sources.catalog import table_detail

    out = None
    for name, path in t.source_paths.items():
        d = table_detail(t.spark.read.parquet(path), name).select("table_name", "num_rows")
        out = d if out is None else out.unionByName(d)
    return out

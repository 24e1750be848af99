"""
2.2-2.7 and 2.12), each with its oracle SQL."""

from __future__ import annotations

from tierwise.functions.money import money, sql_div_half_up
from tierwise.operators import quality as Q
from tierwise.operators import reports as R
from tierwise.operators import spend as S
from tierwise.operators import tiers as T
from tierwise.plans.oracle_views import (
    EARNED,
    MOVES,
    PRICE,
    RULES,
    SPENDING,
    STANDINGS,
    UPDATED,
    avg_sql,
    money_sql,
    rank_sql,
    tier_sql,
    with_views,
)
from tierwise.plans.registry import query

TIERS = RULES.tiers
TOP_TIER, TOP_MIN = RULES.thresholds[0]
SECOND_TIER = RULES.thresholds[1][0]

# -- spend and tiers ----------------------------------------------------------------


@query("customer_spend", with_views(
    f"SELECT customer_id, {money_sql('paid')} AS total_spend FROM bought "
    "WHERE customer_id IN (SELECT customer_id FROM customers)", *SPENDING))
def customer_spend(t):
    return R.customer_spend_report(t)


@query("customer_tiers", with_views(
    f"SELECT customer_id, {money_sql('paid')} AS total_spend, tier AS new_tier FROM earned", *SPENDING, EARNED))
def customer_tiers(t):
    return T.customer_tiers(t).select("customer_id", money("total_spend").alias("total_spend"), "new_tier")


@query("tier_changes", with_views(
    f"SELECT customer_id, tier AS new_tier, {money_sql('paid')} AS total_spend FROM moved", *MOVES))
def tier_changes(t):
    return T.tier_changes(t).select("customer_id", "new_tier", money("total_spend").alias("total_spend"))


@query("tier_update_count", with_views("SELECT COUNT(*) AS updated_count FROM moved", *MOVES))
def tier_update_count(t):
    return T.tier_update_count(t)


@query("top_tier_changes", with_views(
    f"SELECT customer_id, tier AS new_tier, {money_sql('paid')} AS total_spend FROM moved "
    "ORDER BY paid DESC, customer_id LIMIT 10", *MOVES))
def top_tier_changes(t):
    return T.top_tier_changes(t).select("customer_id", "new_tier", money("total_spend").alias("total_spend"))


@query("apply_tier_changes", with_views("FROM after_run", *UPDATED))
def apply_tier_changes(t):
    return T.apply_tier_changes(t)


_TIER_LIST = ", ".join(f"('{tr}')" for tr in TIERS)


@query("tier_shift", with_views(
    f"""SELECT segment, COUNT(*) FILTER (WHERE side = 'old') AS before, COUNT(*) FILTER (WHERE side = 'new') AS after,
       COUNT(*) FILTER (WHERE side = 'new') - COUNT(*) FILTER (WHERE side = 'old') AS change
FROM (VALUES {_TIER_LIST}) listed(segment) LEFT JOIN (
  SELECT 'old' AS side, segment FROM customers UNION ALL SELECT 'new', segment FROM after_run) both_sides USING (segment)
GROUP BY segment""", *UPDATED))
def tier_shift(t):
    return T.tier_shift(t)


@query("idempotent_second_run", with_views(
    """SELECT COUNT(*) AS second_run_changes FROM earned
WHERE EXISTS (FROM after_run held WHERE held.customer_id = earned.customer_id AND held.segment <> earned.tier)""", *UPDATED))
def idempotent_second_run(t):
    return T.idempotent_second_run(t)


@query("tier_count", with_views(
    f"SELECT '{TOP_TIER}' AS tier_name, COUNT(*) FILTER (WHERE segment = '{TOP_TIER}') AS tier_count FROM customers"))
def tier_count(t):
    return T.tier_count(t.customers, TOP_TIER)


# -- reports ------------------------------------------------------------------------


def _paid_figures(*first: str) -> str:
    """Smallest, mean and largest payment of the customers of a segment."""
    figures = (*first, f"{money_sql('MIN(paid)')} AS min_spend", f"{avg_sql('paid')} AS avg_spend", f"{money_sql('MAX(paid)')} AS max_spend")
    return ", ".join(figures)


@query("tier_stats", with_views(
    f"""SELECT segment, {_paid_figures('COUNT(DISTINCT customer_id) AS customer_count')}, {money_sql('SUM(paid)')} AS total_revenue
FROM standing GROUP BY segment ORDER BY {rank_sql('segment')}, segment""", *STANDINGS))
def tier_stats(t):
    return R.tier_stats(t)


@query("spending_ranges", with_views(
    f"""SELECT segment, {_paid_figures('COUNT(*) AS customer_count')}
FROM standing GROUP BY segment ORDER BY {rank_sql('segment')}, segment""", *STANDINGS))
def spending_ranges(t):
    return R.spending_ranges(t)


@query("segment_counts", with_views('SELECT segment, COUNT(*) AS "count" FROM customers GROUP BY ALL ORDER BY ALL'))
def segment_counts(t):
    return R.segment_counts(t.customers)


_IN_TIERS = ", ".join(f"'{tr}'" for tr in TIERS)


@query("segment_totals", with_views(
    f"""SELECT COALESCE(segment, 'TOTAL') AS segment, COUNT(*) AS customer_count
FROM customers WHERE segment IN ({_IN_TIERS}) GROUP BY GROUPING SETS ((segment), ())
HAVING segment IS NOT NULL OR GROUPING(segment) = 1"""))
def segment_totals(t):
    return R.segment_totals(t)


def _top_sql(where: str, count_name: str, k: int) -> str:
    return with_views(
        f"""SELECT customer_id, cust_name, segment, {money_sql('paid')} AS total_spend, purchases AS {count_name}
FROM standing WHERE paid IS NOT NULL{where} ORDER BY paid DESC, customer_id LIMIT {k}""", *STANDINGS)


@query("top_customers", _top_sql("", "transaction_count", 20))
def top_customers(t):
    return R.top_customers(t, 20)


@query("top_gold", _top_sql(f" AND segment = '{TOP_TIER}'", "num_transactions", 10))
def top_gold(t):
    return R.top_in_tier(t, TOP_TIER, 10)


@query("top_silver", _top_sql(f" AND segment = '{SECOND_TIER}'", "num_transactions", 10))
def top_silver(t):
    return R.top_in_tier(t, SECOND_TIER, 10)


@query("top_n_per_tier", with_views(
    f"""SELECT customer_id, cust_name, segment, {money_sql('paid')} AS total_spend, purchases AS num_transactions
FROM standing WHERE segment IS NOT NULL AND paid IS NOT NULL
QUALIFY ROW_NUMBER() OVER (PARTITION BY segment ORDER BY paid DESC, customer_id) <= 10""", *STANDINGS))
def top_n_per_tier(t):
    return R.top_n_per_tier(t, 10)


@query("category_counts", with_views('SELECT category, COUNT(*) AS "count" FROM products GROUP BY ALL ORDER BY ALL'))
def category_counts(t):
    return R.category_counts(t.products)


@query("category_price_stats", with_views(
    f"""SELECT category, n AS product_count, {money_sql('low')} AS min_price, middle AS avg_price, {money_sql('high')} AS max_price
FROM kinds ORDER BY category""",
    f"""kinds AS (
  SELECT category, COUNT(*) AS n, MIN(unit_price) AS low, MAX(unit_price) AS high, {avg_sql('unit_price')} AS middle
  FROM products GROUP BY category)"""))
def category_price_stats(t):
    return R.category_price_stats(t.products)


# per sold product first, then per category
@query("revenue_by_category", with_views(
    f"""SELECT category, CAST(SUM(lines) AS BIGINT) AS transaction_count, {money_sql('SUM(units * cost)')} AS total_revenue,
       {sql_div_half_up('SUM(units * cost)', 'SUM(counted * priced)')} AS avg_transaction_value
FROM (SELECT product_id, category, SUM(unit_price) AS cost, COUNT(unit_price) AS priced FROM products GROUP BY ALL) kinds
JOIN (SELECT product_id, COUNT(*) AS lines, COUNT(quantity) AS counted, SUM(quantity) AS units
      FROM sales_transactions GROUP BY product_id) sold USING (product_id)
GROUP BY category ORDER BY total_revenue DESC, category"""))
def revenue_by_category(t):
    return R.revenue_by_category(t)


@query("transaction_details", with_views(
    f"""SELECT txn_id, cust_name, product_name, category, quantity, unit_price,
       {money_sql('quantity * unit_price')} AS line_total, txn_date
FROM products JOIN sales_transactions USING (product_id) JOIN customers USING (customer_id)
ORDER BY txn_id, cust_name, product_name LIMIT 20"""))
def transaction_details(t):
    return S.transaction_details(t, 20)


# -- quality ------------------------------------------------------------------------


_ACTUAL = """actual_rows AS (
  SELECT 'customers' AS table_name, COUNT(*) AS actual FROM customers
  UNION ALL SELECT 'products', COUNT(*) FROM products
  UNION ALL SELECT 'sales_transactions', COUNT(*) FROM sales_transactions)"""
_EXPECTED = """raw_rows AS (
  SELECT 'customers' AS table_name, COUNT(*) AS expected FROM customer
  UNION ALL SELECT 'products', COUNT(*) FROM part
  UNION ALL SELECT 'sales_transactions', COUNT(*) FROM lineitem)"""


@query("scan_counts", with_views("SELECT table_name, actual AS row_count FROM actual_rows", _ACTUAL))
def scan_counts(t):
    return Q.scan_counts(t)


@query("volume_check", with_views(
    """SELECT table_name, actual, expected, IF(actual = expected, 'PASS', 'FAIL') AS status
FROM actual_rows JOIN raw_rows USING (table_name)""", _ACTUAL, _EXPECTED))
def volume_check(t):
    return Q.volume_check(t)


# tier that a customer's payments call for, none counting as the lowest
_DUE = f"""due AS (
  SELECT customer_id, cust_name, segment, paid, {tier_sql('paid')} AS tier FROM standing)"""


@query("validate_tiers", with_views(
    f"""SELECT customer_id, cust_name, segment AS assigned_tier, {money_sql('paid')} AS total_spend, tier AS expected_tier,
       IF(segment IS NOT DISTINCT FROM tier, 'PASS', 'FAIL') AS validation_result
FROM due""", *STANDINGS, _DUE))
def validate_tiers(t):
    return Q.validate_tiers(t)


@query("validate_tiers_summary", with_views(
    """SELECT IF(segment IS NOT DISTINCT FROM tier, 'PASS', 'FAIL') AS validation_result, COUNT(*) AS "count"
FROM due GROUP BY ALL""", *STANDINGS, _DUE))
def validate_tiers_summary(t):
    return Q.validate_tiers_summary(t)


def _band_sql() -> str:
    bands = []
    for tier in RULES.tiers:
        low, high = RULES.band(tier)
        if low is not None:
            bands.append(f"('{tier} min spend >= {low}', '{tier}', TRUE, {low})")
        if high is not None:
            bands.append(f"('{tier} max spend < {high}', '{tier}', FALSE, {high})")
    return with_views(
        f"""SELECT check_item, {money_sql('seen')} AS actual, {money_sql('bound')} AS bound,
       CASE WHEN seen IS NULL THEN 'SKIPPED' WHEN lower_end = (seen >= bound) THEN 'PASS' ELSE 'FAIL' END AS status
FROM (
  SELECT check_item, lower_end, bound, IF(lower_end, MIN(paid), MAX(paid)) AS seen
  FROM (VALUES {', '.join(bands)}) band(check_item, segment, lower_end, bound) LEFT JOIN standing USING (segment)
  GROUP BY check_item, lower_end, bound) ends""", *STANDINGS)


@query("tier_band_check", _band_sql())
def tier_band_check(t):
    return Q.tier_band_check(t)


def _null_sql() -> str:
    parts = []
    for table, cols in Q.NULL_CHECK_COLUMNS.items():
        for c in cols:
            parts.append(f"""SELECT '{table}' AS "table", '{c}' AS "column", COUNT(*) - COUNT({c}) AS null_count FROM {table}""")
    union = "\nUNION ALL\n".join(parts)
    return with_views(f"""SELECT *, IF(null_count > 0, 'FAIL', 'PASS') AS status FROM ({union}) gaps""")


@query("null_checks", _null_sql())
def null_checks(t):
    return Q.null_checks(t)


@query("null_profile", with_views(
    """SELECT 'customers' AS table_name, COUNT(*) - COUNT(customer_id) AS null_customer_ids,
       COUNT(*) - COUNT(cust_name) AS null_names, COUNT(*) - COUNT(segment) AS null_segments
FROM customers"""))
def null_profile(t):
    return Q.null_profile(t)


def _orphans(key: str, dim: str) -> str:
    return f"(SELECT COUNT(*) FROM sales_transactions f WHERE NOT EXISTS (FROM {dim} d WHERE d.{key} = f.{key}))"


@query("orphan_customers", with_views(f"SELECT {_orphans('customer_id', 'customers')} AS orphaned_count"))
def orphan_customers(t):
    return Q.orphan_customers(t)


@query("orphan_products", with_views(f"SELECT {_orphans('product_id', 'products')} AS orphaned_count"))
def orphan_products(t):
    return Q.orphan_products(t)


@query("duplicate_customers", with_views(
    """SELECT DISTINCT customer_id, cnt
FROM (SELECT customer_id, COUNT(*) OVER (PARTITION BY customer_id) AS cnt FROM customers) seen WHERE cnt >= 2"""))
def duplicate_customers(t):
    return Q.duplicate_customers(t)


@query("gold_violations", with_views(
    f"SELECT COUNT(*) FILTER (WHERE segment = '{TOP_TIER}' AND paid < {TOP_MIN}) AS violation_count FROM standing", *STANDINGS))
def gold_violations(t):
    return Q.gold_violations(t)


@query("tier_mismatches", with_views(
    f"""SELECT customer_id, segment, {money_sql('owed')} AS total_spend, {tier_sql('owed')} AS expected_segment
FROM (SELECT customer_id, segment, COALESCE(paid, 0) AS owed FROM standing) zeroed
WHERE segment <> {tier_sql('owed')}""", *STANDINGS))
def tier_mismatches(t):
    return Q.tier_mismatches(t)


@query("tier_total_check", with_views(
    f"""SELECT tier_total, customer_total, IF(tier_total = customer_total, 'PASS', 'FAIL') AS status
FROM (SELECT COUNT(CASE WHEN segment IN ({_IN_TIERS}) THEN 1 END) AS tier_total, COUNT(*) AS customer_total FROM customers) sums"""))
def tier_total_check(t):
    return Q.tier_total_check(t)


_REPORT_ITEMS = ", ".join(f"('{k}', '{v}')" for k, v in Q.REPORT_TABLE_ITEMS.items())


@query("validation_report", with_views(
    f"""SELECT Check_Category, Check_Item, CAST(found AS VARCHAR) AS Actual, CAST(wanted AS VARCHAR) AS Expected,
       IF(found = wanted, 'PASS', 'FAIL') AS Status
FROM (
  SELECT '{Q.REPORT_VOLUME}' AS Check_Category, label AS Check_Item, actual AS found, expected AS wanted
  FROM actual_rows JOIN raw_rows USING (table_name) JOIN (VALUES {_REPORT_ITEMS}) named(table_name, label) USING (table_name)
  UNION ALL
  SELECT '{Q.REPORT_TIERS}', '{Q.REPORT_ALL_TIERS}', COUNT(*) FILTER (WHERE segment IS NOT DISTINCT FROM tier), COUNT(*) FROM due
  UNION ALL SELECT '{Q.REPORT_REFERENCES}', '{Q.REPORT_CUSTOMER_FK}', {_orphans('customer_id', 'customers')}, 0
  UNION ALL SELECT '{Q.REPORT_REFERENCES}', '{Q.REPORT_PRODUCT_FK}', {_orphans('product_id', 'products')}, 0) checks""",
    *STANDINGS, _DUE, _ACTUAL, _EXPECTED))
def validation_report(t):
    return Q.validation_report(t)


@query("check_constraints", with_views(
    """SELECT 'quantity_positive' AS constraint_name, COUNT(*) FILTER (WHERE quantity <= 0) AS violations FROM sales_transactions
UNION ALL
SELECT 'unit_price_non_negative', COUNT(*) FILTER (WHERE unit_price < 0) FROM products"""))
def check_constraints(t):
    return Q.check_constraints(t)

"""SQL helpers for the DuckDB oracle: the view layer of FIXTURES.md section B
as CTEs over the raw driver tables, and the per-customer and per-product
facts that the questions are answered from."""

from __future__ import annotations

from tierwise.functions.money import sql_avg_half_up
from tierwise.rules import DRIVER_RULES

VIEWS = """customers AS (
  SELECT c_custkey AS customer_id, c_name AS cust_name,
         CASE WHEN c_custkey % 50 = 0 THEN NULL
              WHEN c_custkey % 3 = 0 THEN 'GOLD'
              WHEN c_custkey % 3 = 1 THEN 'SILVER' ELSE 'BRONZE' END AS segment,
         CAST(DATE '2001-08-01' - CAST(c_custkey % 1000 + 1 AS INTEGER) AS DATE) AS signup_date
  FROM customer),
products AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
         CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price
  FROM part),
sales_transactions AS (
  SELECT ROW_NUMBER() OVER (ORDER BY l_orderkey NULLS FIRST, l_linenumber NULLS FIRST, l_partkey NULLS FIRST,
             l_suppkey NULLS FIRST, l_quantity NULLS FIRST, l_extendedprice NULLS FIRST, l_discount NULLS FIRST,
             l_tax NULLS FIRST, l_returnflag NULLS FIRST, l_linestatus NULLS FIRST, l_shipdate NULLS FIRST,
             o_custkey NULLS FIRST, o_orderdate NULLS FIRST) AS txn_id,
         o_custkey AS customer_id, l_partkey AS product_id,
         CAST(l_quantity AS INT) AS quantity, CAST(o_orderdate AS DATE) AS txn_date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

RULES = DRIVER_RULES


def with_views(body: str, *ctes: str) -> str:
    extra = "".join(f",\n{c}" for c in ctes)
    return f"WITH {VIEWS}{extra}\n{body}"


def tier_sql(spend: str) -> str:
    return RULES.sql_tier_of(spend)


def rank_sql(seg: str) -> str:
    return RULES.sql_rank_of(seg)


def money_sql(expr: str) -> str:
    return f"CAST({expr} AS DECIMAL(38,2))"


def avg_sql(expr: str) -> str:
    return sql_avg_half_up(expr)


# what one unit of a product costs over its product rows
PRICE = """price AS (
  SELECT product_id, SUM(unit_price) AS per_unit, COUNT(unit_price) AS priced_rows, COUNT(*) AS product_rows
  FROM products GROUP BY product_id)"""

# what each buyer has paid, known customer or not
BOUGHT = """bought AS (
  SELECT customer_id, SUM(quantity * per_unit) AS paid, COUNT(DISTINCT txn_id) AS purchases
  FROM sales_transactions JOIN price USING (product_id) GROUP BY customer_id)"""

# every customer with what they have paid, NULL if nothing
STANDING = """standing AS (
  SELECT customer_id, cust_name, segment, signup_date, paid, purchases
  FROM customers LEFT JOIN bought USING (customer_id))"""

# the tier that each buying customer's payments earn
EARNED = f"""earned AS (
  SELECT customer_id, paid, {tier_sql('paid')} AS tier FROM bought
  WHERE customer_id IN (SELECT customer_id FROM customers))"""

# earned tiers that the customer doesn't hold
MOVED = """moved AS (
  SELECT customer_id, tier, paid FROM earned
  WHERE EXISTS (FROM customers held WHERE held.customer_id = earned.customer_id AND held.segment <> earned.tier))"""

# customers after the moves
AFTER = """after_run AS (
  SELECT customer_id, cust_name, CASE WHEN tier IS NULL THEN segment ELSE tier END AS segment, signup_date
  FROM customers LEFT JOIN moved USING (customer_id))"""

SPENDING = (PRICE, BOUGHT)
STANDINGS = (PRICE, BOUGHT, STANDING)
MOVES = (PRICE, BOUGHT, EARNED, MOVED)
UPDATED = (*MOVES, AFTER)

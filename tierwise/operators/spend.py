"""Spend over the star: line totals, per-customer spend, per-customer
spend with transaction counts.

Plan shape (per customer): fact scan -> join of the product prices (broadcast
where Spark's size threshold allows, at planning or at run time) -> partial
aggregate by customer -> one exchange by customer -> final aggregate -> join
customers on the same partitioning.  A customer holding a large share of the
fact never reaches one task as raw rows: the map-side partial aggregate
collapses it to one row per input partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwise.sources.model import Tables


def priced_lines(t: Tables, keep: tuple[str, ...] = (), eager: bool = False) -> DataFrame:
    """Transactions inner-joined to products with ``amount = unit_price * quantity``
    (per-product price sums, see ``Tables.product_prices``).

    ``eager`` first reduces the fact to one row per (customer, product) -
    exact, because the price is constant per product - so that a shuffle join
    moves pairs, not transactions.  ``keep`` asks for extra transaction
    columns.
    """
    if eager and not keep:
        lines = t.transactions.groupBy("customer_id", "product_id").agg(F.sum("quantity").alias("quantity"))
    else:
        facts = t.numbered() if "txn_id" in keep else t.transactions
        lines = facts.select("customer_id", "product_id", "quantity", *keep)
    return lines.join(t.product_prices(), "product_id", "inner").select(
        "customer_id", "product_id", *keep, (F.col("unit_price") * F.col("quantity")).alias("amount")
    )


def spend_by_customer(t: Tables, eager: bool = False) -> DataFrame:
    """customer_id, total_spend over transactions joined to products only
    (no customers join).  A customer whose transactions all miss their
    product is absent, which a LEFT JOIN from customers turns into the same
    NULL as SUM over NULL amounts."""
    return priced_lines(t, eager=eager).groupBy("customer_id").agg(F.sum("amount").alias("total_spend"))


def customer_spend(t: Tables, eager: bool = False) -> DataFrame:
    """customer_id, total_spend: SUM(unit_price * quantity) over the
    transactions of known customers.

    Inner join semantics: orphan transactions drop out, customers without
    transactions are absent, a duplicated customer row counts its
    transactions once per copy (as the join does).
    """
    return (
        spend_by_customer(t, eager)
        .join(t.customers.select("customer_id"), "customer_id", "inner")
        .groupBy("customer_id")
        .agg(F.sum("total_spend").alias("total_spend"))
    )


def spend_and_count_by_customer(t: Tables) -> DataFrame:
    """customer_id, total_spend, txn_count (COUNT(DISTINCT txn_id)) over the
    transactions that join a product.  Where txn_id is a key, rows are
    counted instead, which reads no id and needs no distinct aggregation."""
    if t.unique_txn_id:
        lines, count = priced_lines(t), F.count(F.lit(1))
    else:
        lines, count = priced_lines(t, keep=("txn_id",)), F.count_distinct("txn_id")
    return lines.groupBy("customer_id").agg(F.sum("amount").alias("total_spend"), count.alias("txn_count"))


def customer_totals(t: Tables, customers: DataFrame | None = None) -> DataFrame:
    """customer_id, cust_name, segment, total_spend, txn_count for customers
    with at least one priced transaction, one row per (customer_id,
    cust_name, segment)."""
    customers = t.customers if customers is None else customers
    per_cust = spend_and_count_by_customer(t)
    return (
        customers.select("customer_id", "cust_name", "segment")
        .join(per_cust, "customer_id", "inner")
        .groupBy("customer_id", "cust_name", "segment")
        # spend repeats once per duplicate customer row; a distinct count does not
        .agg(F.sum("total_spend").alias("total_spend"), F.max("txn_count").alias("txn_count"))
    )


def transaction_details(t: Tables, limit: int | None = 20) -> DataFrame:
    """txn_id, cust_name, product_name, category, quantity, unit_price,
    line_total, txn_date - the first ``limit`` transactions by txn_id.

    Where txn_id is a key, the head is taken first: the ``limit`` smallest
    ids among the transactions with a known customer and product (semi joins
    on narrow rows, a per-partition top-k), and only those rows are joined to
    the wide dimensions.  An id that would have to be built is counted for
    those rows alone.  Otherwise ids may tie at the cut, and the full join is
    limited."""
    order = ["txn_id", "cust_name", "product_name", "quantity", "unit_price", "txn_date"]

    def known(facts: DataFrame) -> DataFrame:
        buyers = facts.join(t.customers.select("customer_id"), "customer_id", "left_semi")
        return buyers.join(t.products.select("product_id"), "product_id", "left_semi")

    if limit and t.unique_txn_id:
        facts = t.first(known, limit) if t.first else known(t.numbered()).orderBy("txn_id").limit(limit)
    else:
        facts = t.numbered()
    rows = (
        facts.join(t.customers.select("customer_id", "cust_name"), "customer_id", "inner")
        .join(t.products.select("product_id", "product_name", "category", "unit_price"), "product_id", "inner")
        .select(
            "txn_id", "cust_name", "product_name", "category", "quantity", "unit_price",
            F.round(F.col("unit_price") * F.col("quantity"), 2).cast("decimal(38,2)").alias("line_total"),
            "txn_date",
        )
        .orderBy(*order)
    )
    return rows.limit(limit) if limit else rows

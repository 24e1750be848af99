"""Ranking, gaps between purchases, date spine, correlated comparison.

The per-group orders (rank within a category, previous purchase of a
customer) go through ``operators.ordered`` so that a hot category or
customer is spread over many tasks instead of one window partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwise.functions.money import money
from tierwise.operators.ordered import lag_within, rank_within
from tierwise.sources.model import Tables


def product_revenue(t: Tables) -> DataFrame:
    """product_id, product_name, category, revenue for sold products."""
    per_product = t.transactions.groupBy("product_id").agg(F.sum("quantity").alias("qty"))
    return per_product.join(
        t.products.select("product_id", "product_name", "category", "unit_price"), "product_id", "inner"
    ).groupBy("product_id", "product_name", "category").agg(
        money(F.sum(F.col("unit_price") * F.col("qty"))).alias("revenue")
    )


def product_rank(t: Tables) -> DataFrame:
    """category, product_id, product_name, revenue, revenue_rank -
    RANK() OVER (PARTITION BY category ORDER BY revenue DESC)."""
    rev = product_revenue(t)
    ranked = rank_within(
        rev, ["category"], [F.col("revenue").desc()], tie=["revenue"], extra=["product_id"], name="revenue_rank"
    )
    return ranked.select("category", "product_id", "product_name", "revenue", "revenue_rank")


def days_between_txns(t: Tables) -> DataFrame:
    """customer_id, txn_id, txn_date, prev_txn_date, days_since_prev - each
    transaction with the previous one of the same customer (by date, then
    txn_id)."""
    tx = t.numbered().select("customer_id", "txn_id", "txn_date")
    with_prev = lag_within(tx, ["customer_id"], ["txn_date", "txn_id"], "txn_date", "prev_txn_date")
    return with_prev.select(
        "customer_id", "txn_id", "txn_date", "prev_txn_date",
        F.datediff("txn_date", "prev_txn_date").alias("days_since_prev"),
    )


def date_spine_revenue(t: Tables) -> DataFrame:
    """txn_date, revenue, txn_count for every day between the first and the
    last transaction, days without sales included with 0.

    The spine is one generated row per calendar day (bounded by the date
    span, not by the data volume); daily revenue is a partial aggregate."""
    lines = t.transactions.select("product_id", "quantity", "txn_date").join(t.product_prices(), "product_id", "inner")
    daily = lines.groupBy("txn_date").agg(
        F.sum(F.col("unit_price") * F.col("quantity")).alias("revenue"), F.sum("_rows").alias("txn_count")
    )
    span = t.transactions.agg(F.min("txn_date").alias("lo"), F.max("txn_date").alias("hi"))
    spine = span.where(F.col("lo").isNotNull()).select(F.explode(F.sequence("lo", "hi")).alias("txn_date"))
    return spine.join(daily, "txn_date", "left").select(
        "txn_date",
        money(F.coalesce(F.col("revenue"), F.lit(0))).alias("revenue"),
        F.coalesce(F.col("txn_count"), F.lit(0)).cast("bigint").alias("txn_count"),
    )


def above_category_avg(t: Tables) -> DataFrame:
    """product_id, product_name, category, unit_price for products priced
    above their category's average - a correlated subquery, decorrelated
    into one aggregate joined on category.  Compared exactly as
    ``price * count > sum`` (no rounded average)."""
    p = t.products
    stats = p.groupBy("category").agg(F.sum("unit_price").alias("_sum"), F.count("unit_price").alias("_n"))
    return (
        p.join(stats, "category", "inner")
        .where(F.col("unit_price") * F.col("_n") > F.col("_sum"))
        .select("product_id", "product_name", "category", "unit_price")
    )

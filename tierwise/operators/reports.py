"""Report set: tier statistics, spending ranges, top customers, category
figures, simple distributions.

Money leaves as decimal(38,2); averages are exact half-up (functions.money).
Every top-k has a total order (spend desc, customer_id asc) so ties cannot
change the result between runs.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierwise.functions.money import avg_half_up, cents_div_half_up, money
from tierwise.operators.keyfilter import keep_keys
from tierwise.operators.spend import customer_spend, customer_totals, spend_by_customer
from tierwise.sources.model import Tables


def _customers_with_spend(t: Tables) -> DataFrame:
    """customers LEFT JOIN (per-customer spend) - one row per customer row."""
    return t.customers.select("customer_id", "segment").join(spend_by_customer(t), "customer_id", "left")


def tier_stats(t: Tables) -> DataFrame:
    """segment, customer_count, min_spend, avg_spend, max_spend, total_revenue."""
    s = F.col("total_spend")
    return (
        _customers_with_spend(t)
        .groupBy("segment")
        .agg(
            F.count_distinct("customer_id").alias("customer_count"),
            money(F.min(s)).alias("min_spend"),
            avg_half_up(s).alias("avg_spend"),
            money(F.max(s)).alias("max_spend"),
            money(F.sum(s)).alias("total_revenue"),
        )
        .orderBy(t.rules.rank_of(F.col("segment")), F.col("segment"))
    )


def spending_ranges(t: Tables, ordered: bool = True) -> DataFrame:
    """segment, customer_count (rows), min_spend, max_spend, avg_spend.
    ``ordered=False`` skips the presentation sort (for internal use)."""
    s = F.col("total_spend")
    out = (
        _customers_with_spend(t)
        .groupBy("segment")
        .agg(
            F.count(F.lit(1)).alias("customer_count"),
            money(F.min(s)).alias("min_spend"),
            money(F.max(s)).alias("max_spend"),
            avg_half_up(s).alias("avg_spend"),
        )
    )
    return out.orderBy(t.rules.rank_of(F.col("segment")), F.col("segment")) if ordered else out


def segment_counts(customers: DataFrame) -> DataFrame:
    """segment, count."""
    return customers.groupBy("segment").agg(F.count(F.lit(1)).alias("count")).orderBy("segment")


def segment_totals(t: Tables) -> DataFrame:
    """segment, customer_count for every tier plus a ``TOTAL`` row (the sum
    of the tier rows; NULL or unknown segments are in neither)."""
    tiers = t.rules.tiers
    per = (
        t.customers.where(F.col("segment").isin(tiers))
        .rollup("segment")
        .agg(F.count(F.lit(1)).alias("customer_count"), F.grouping("segment").alias("g"))
    )
    return per.select(
        F.when(F.col("g") == 1, F.lit("TOTAL")).otherwise(F.col("segment")).alias("segment"), "customer_count"
    )


def top_customers(t: Tables, k: int = 20) -> DataFrame:
    """customer_id, cust_name, segment, total_spend, transaction_count -
    global top ``k`` by spend."""
    return (
        customer_totals(t)
        .orderBy(F.col("total_spend").desc(), F.col("customer_id").asc())
        .limit(k)
        .select(
            "customer_id", "cust_name", "segment", money("total_spend").alias("total_spend"),
            F.col("txn_count").alias("transaction_count"),
        )
    )


def of_tier(t: Tables, tier: str, bits: int | None = None) -> Tables:
    """The customers of one tier, and the transactions that may be theirs:
    those of other customers go before any exchange (``operators.keyfilter``)."""
    customers = t.customers.where(F.col("segment") == F.lit(tier))

    def kept(facts: DataFrame) -> DataFrame:
        return keep_keys(facts, customers, "customer_id", bits)

    number = t.number and (lambda: kept(t.numbered()))
    return replace(t, customers=customers, transactions=kept(t.transactions), number=number, first=None)


def top_in_tier(t: Tables, tier: str, k: int = 10) -> DataFrame:
    """customer_id, cust_name, segment, total_spend, num_transactions - top
    ``k`` of one tier (the segment filter reaches the fact's scan)."""
    return (
        customer_totals(of_tier(t, tier))
        .orderBy(F.col("total_spend").desc(), F.col("customer_id").asc())
        .limit(k)
        .select(
            "customer_id", "cust_name", "segment", money("total_spend").alias("total_spend"),
            F.col("txn_count").alias("num_transactions"),
        )
    )


def top_n_per_tier(t: Tables, k: int = 10) -> DataFrame:
    """Top ``k`` per segment in one pass: ROW_NUMBER over segment.  Spark
    plans a per-partition group limit before the exchange, so at most ``k``
    rows per segment and input partition are shuffled.  Spark adds that
    limit only up to ``spark.sql.optimizer.windowGroupLimitThreshold``;
    beyond it the row numbers come from ``ordered.row_number_within``
    (one range sort, no window over the segment)."""
    order = [F.col("total_spend").desc(), F.col("customer_id").asc(), F.col("cust_name").asc()]
    totals = customer_totals(t).where(F.col("segment").isNotNull())
    limit = int(t.spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if k <= limit:
        ranked = totals.withColumn("rn", F.row_number().over(Window.partitionBy("segment").orderBy(*order)))
    else:
        from tierwise.operators.ordered import row_number_within

        ranked = row_number_within(totals, ["segment"], order, "rn")
    return (
        ranked.where(F.col("rn") <= k)
        .select(
            "customer_id", "cust_name", "segment", money("total_spend").alias("total_spend"),
            F.col("txn_count").alias("num_transactions"),
        )
    )


def category_counts(products: DataFrame) -> DataFrame:
    """category, count."""
    return products.groupBy("category").agg(F.count(F.lit(1)).alias("count")).orderBy("category")


def category_price_stats(products: DataFrame) -> DataFrame:
    """category, product_count, min_price, avg_price, max_price."""
    p = F.col("unit_price")
    return (
        products.groupBy("category")
        .agg(
            F.count(F.lit(1)).alias("product_count"),
            money(F.min(p)).alias("min_price"),
            avg_half_up(p).alias("avg_price"),
            money(F.max(p)).alias("max_price"),
        )
        .orderBy("category")
    )


def revenue_by_category(t: Tables) -> DataFrame:
    """category, transaction_count, total_revenue, avg_transaction_value."""
    products = t.product_prices("category")
    if t.unique_txn_id:
        # one row per product before the join: quantity sum,
        # transactions, and transactions with a quantity (AVG's terms)
        per_product = t.transactions.groupBy("product_id").agg(
            F.sum("quantity").alias("quantity"),
            F.count(F.lit(1)).alias("n"),
            F.count("quantity").alias("n_qty"),
        )
        lines = per_product.join(products, "product_id", "inner")
        count = F.sum("n")
        terms = F.col("n_qty") * F.col("_priced_rows")
    else:
        lines = t.numbered().select("txn_id", "product_id", "quantity").join(products, "product_id", "inner")
        count = F.count_distinct("txn_id")
        # AVG over the row join: one term per (transaction, priced product row)
        terms = F.when(F.col("quantity").isNotNull(), F.col("_priced_rows")).otherwise(F.lit(0))
    amount = F.col("unit_price") * F.col("quantity")
    return (
        lines.groupBy("category")
        .agg(
            count.alias("transaction_count"),
            money(F.sum(amount)).alias("total_revenue"),
            cents_div_half_up(F.sum(amount), F.sum(terms)).alias("avg_transaction_value"),
        )
        .orderBy(F.col("total_revenue").desc(), F.col("category"))
    )


def customer_spend_report(t: Tables) -> DataFrame:
    """customer_id, total_spend rounded to money (the spend cursor)."""
    return customer_spend(t).select("customer_id", money("total_spend").alias("total_spend"))


__all__ = [
    "category_counts", "category_price_stats", "customer_spend_report",
    "revenue_by_category", "segment_counts", "segment_totals", "spending_ranges", "tier_stats",
    "top_customers", "top_in_tier", "top_n_per_tier",
]

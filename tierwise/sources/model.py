"""The three-table star as a bundle of DataFrames.

``Tables`` carries customers, products and sales_transactions plus the tier
rules and the "today" of the data.  ``from_tpch`` builds one over the driver's
TPC-H style parquet (customer, part, orders, lineitem), seen through the view
layer of FIXTURES.md section B; ``plans.pipeline`` builds one over a stored
star.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwise.rules import DEFAULT_RULES, DRIVER_RULES, TierRules
from tierwise.schemas import CUSTOMERS, PRICE, PRODUCTS, SALES_TRANSACTIONS, conform


@dataclass
class Tables:
    """``transactions`` may lack ``txn_id`` where that id has to be built;
    queries that read the id ask for ``numbered()``."""

    customers: DataFrame
    products: DataFrame
    transactions: DataFrame
    rules: TierRules = DEFAULT_RULES
    as_of: dt.date | None = None
    # raw row counts of the sources the view layer reads, for volume checks
    source_counts: dict[str, DataFrame] = field(default_factory=dict)
    source_paths: dict[str, str] = field(default_factory=dict)
    # txn_id is a key without NULLs (built so, or verified): counting rows is
    # then COUNT(DISTINCT txn_id), without a distinct aggregation
    unique_txn_id: bool = False
    # builds the transactions with their txn_id, on first use
    number: Callable[[], DataFrame] | None = None
    # the first k transactions by txn_id among those that the given function
    # keeps, for bundles that can tell them without numbering every one
    first: Callable[[Callable[[DataFrame], DataFrame], int], DataFrame] | None = None

    @property
    def spark(self) -> SparkSession:
        return self.customers.sparkSession

    def with_customers(self, customers: DataFrame) -> "Tables":
        return replace(self, customers=customers)

    def numbered(self) -> DataFrame:
        """The transactions with ``txn_id``."""
        return self.transactions if self.number is None else self.number()

    def product_prices(self, *by: str) -> DataFrame:
        """product_id, *by, unit_price = SUM(unit_price) over the product
        rows sharing (product_id, *by).

        Joining this instead of products gives every sum of
        ``unit_price * quantity`` the row join gives (one term per product
        row), but never multiplies fact rows, so per-transaction counts stay
        counts.  Spark's size statistics decide whether it is broadcast;
        otherwise the aggregate's exchange by product_id is the one the
        shuffle join needs."""
        return self.products.groupBy("product_id", *by).agg(
            F.sum("unit_price").alias("unit_price"),
            # product rows behind each sum: the row join's row counts
            F.count("unit_price").alias("_priced_rows"),
            F.count(F.lit(1)).alias("_rows"),
        )


# ---------------------------------------------------------------------------
# Driver tables -> star (FIXTURES.md section B)
# ---------------------------------------------------------------------------

# Fixed values of the view layer: the data's latest order date, and the
# columns whose order numbers the lines.
TPCH_AS_OF = dt.date(2001, 8, 1)
TXN_ORDER_COLUMNS = (
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
)


def _segment_of_custkey(k):
    return (
        F.when(k % 50 == 0, F.lit(None).cast("string"))
        .when(k % 3 == 0, F.lit("GOLD"))
        .when(k % 3 == 1, F.lit("SILVER"))
        .otherwise(F.lit("BRONZE"))
    )


def tpch_customers(spark: SparkSession, sf_dir: str, as_of: dt.date = TPCH_AS_OF) -> DataFrame:
    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    k = F.col("c_custkey")
    return conform(
        c.select(
            k.alias("customer_id"),
            F.col("c_name").alias("cust_name"),
            _segment_of_custkey(k).alias("segment"),
            F.date_sub(F.lit(as_of), (k % 1000 + 1).cast("int")).alias("signup_date"),
        ),
        CUSTOMERS,
    )


def tpch_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = spark.read.parquet(f"{sf_dir}/part.parquet")
    return conform(
        p.select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"),
            F.col("p_retailprice").cast(PRICE).alias("unit_price"),
        ),
        PRODUCTS,
    )


def tpch_transactions(spark: SparkSession, sf_dir: str, keyed: bool = False) -> DataFrame:
    """Every line of every order as a transaction.

    ``(l_orderkey, l_linenumber)`` repeats, so with ``keyed`` the lines get
    the consecutive ``txn_id`` 1..n over their columns, orders first
    (``operators.ordered``: one range sort, no window over a key).  That id is
    unique whatever the number of lines in an order."""
    joined = _tpch_lines(spark, sf_dir, TXN_ORDER_COLUMNS if keyed else ("l_orderkey", "l_partkey", "l_quantity"))
    if not keyed:
        wanted = [f for f in SALES_TRANSACTIONS.fields if f.name != "txn_id"]
        rows = joined.select(*_line_columns())
        return rows.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in wanted])
    from tierwise.operators.ordered import global_row_number

    order = [F.col(c).asc_nulls_first() for c in _LINE_ORDER]
    return conform(global_row_number(joined, order, "txn_id").select("txn_id", *_line_columns()), SALES_TRANSACTIONS)


_LINE_ORDER = (*TXN_ORDER_COLUMNS, "o_custkey", "o_orderdate")


def _tpch_lines(spark: SparkSession, sf_dir: str, used: tuple[str, ...]) -> DataFrame:
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(*used)
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderdate")
    return li.join(o, li["l_orderkey"] == o["o_orderkey"], "inner")


def _line_columns() -> list[Column]:
    return [
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("o_orderdate").cast("date").alias("txn_date"),
    ]


def tpch_first_transactions(
    spark: SparkSession, sf_dir: str, keep: Callable[[DataFrame], DataFrame], k: int
) -> DataFrame:
    """The first ``k`` transactions by ``txn_id`` among those that ``keep``
    returns (it may only drop rows, by customer_id or product_id).  Their ids
    are those of ``tpch_transactions(keyed=True)``, counted instead of built
    (``operators.ordered.numbers_of_smallest``)."""
    from tierwise.operators.ordered import numbers_of_smallest

    lines = _tpch_lines(spark, sf_dir, TXN_ORDER_COLUMNS)
    kept = keep(lines.select("*", F.col("o_custkey").alias("customer_id"), F.col("l_partkey").alias("product_id")))
    found = numbers_of_smallest(lines, kept.select(*lines.columns), _LINE_ORDER, k, "txn_id", lead="l_orderkey")
    return conform(found.select("txn_id", *_line_columns()), SALES_TRANSACTIONS)


def from_tpch(
    spark: SparkSession, sf_dir: str, rules: TierRules = DRIVER_RULES, as_of: dt.date = TPCH_AS_OF
) -> Tables:
    """The star over the driver's tables, composed lazily: nothing is read,
    sorted or written until a query needs it."""

    def rows(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet").agg(F.count(F.lit(1)).alias("n"))

    return Tables(
        customers=tpch_customers(spark, sf_dir, as_of),
        products=tpch_products(spark, sf_dir),
        transactions=tpch_transactions(spark, sf_dir),
        rules=rules,
        as_of=as_of,
        source_counts={"customers": rows("customer"), "products": rows("part"), "sales_transactions": rows("lineitem")},
        source_paths={n: f"{sf_dir}/{n}.parquet" for n in ("customer", "part", "orders", "lineitem")},
        unique_txn_id=True,
        number=lambda: tpch_transactions(spark, sf_dir, keyed=True),
        first=lambda keep, k: tpch_first_transactions(spark, sf_dir, keep, k),
    )

"""Deterministic, distributed test-data generator for the star.

Rows come from ``spark.range`` and every column is a pure function of the
row id and a seed, so the data are the same for any number of partitions
or executors and can be regenerated piecewise.  Nothing is built on the
driver.

Defaults are the reference set (50 products, 500 customers, 10,000
transactions); any size works.  ``hot_share`` sends that share of all
transactions to customer 1, for testing skew handling.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwise.schemas import CUSTOMERS, PRODUCTS, SALES_TRANSACTIONS, conform

# The category of product i by i mod 3, the name prefixes,
# and the reference volumes.
CATEGORY_BY_MOD3 = {0: "Electronics", 1: "Home", 2: "Clothing"}
PRODUCT_NAME_PREFIX = "Product_"
CUSTOMER_NAME_PREFIX = "Customer_"
REFERENCE_SIZES = {"products": 50, "customers": 500, "sales_transactions": 10000}


@dataclass(frozen=True)
class GenSpec:
    products: int = REFERENCE_SIZES["products"]
    customers: int = REFERENCE_SIZES["customers"]
    transactions: int = REFERENCE_SIZES["sales_transactions"]
    seed: int = 13
    as_of: dt.date = dt.date(2024, 1, 1)
    default_tier: str = "BRONZE"
    hot_share: float = 0.0
    partitions: int | None = None


def _u(id_col: Column, seed: int, salt: int) -> Column:
    """A well-mixed non-negative 63-bit value per (id, seed, salt)."""
    return F.abs(F.xxhash64(id_col, F.lit(seed), F.lit(salt)) % F.lit(1 << 62))


def _range(spark: SparkSession, n: int, partitions: int | None) -> DataFrame:
    return spark.range(1, n + 1, numPartitions=partitions) if partitions else spark.range(1, n + 1)


def gen_products(spark: SparkSession, spec: GenSpec = GenSpec()) -> DataFrame:
    i = F.col("id")
    category = F.when(i % 3 == 0, CATEGORY_BY_MOD3[0]).when(i % 3 == 1, CATEGORY_BY_MOD3[1]).otherwise(CATEGORY_BY_MOD3[2])
    # 10.00 .. 500.00 in cents
    cents = F.lit(1000) + _u(i, spec.seed, 1) % F.lit(49001)
    return conform(
        _range(spark, spec.products, spec.partitions).select(
            i.alias("product_id"),
            F.concat(F.lit(PRODUCT_NAME_PREFIX), i.cast("string")).alias("product_name"),
            category.alias("category"),
            (cents.cast("decimal(18,0)") * F.lit(0.01).cast("decimal(3,2)")).alias("unit_price"),
        ),
        PRODUCTS,
    )


def gen_customers(spark: SparkSession, spec: GenSpec = GenSpec()) -> DataFrame:
    i = F.col("id")
    days_ago = (F.lit(1) + _u(i, spec.seed, 2) % F.lit(1000)).cast("int")
    return conform(
        _range(spark, spec.customers, spec.partitions).select(
            i.alias("customer_id"),
            F.concat(F.lit(CUSTOMER_NAME_PREFIX), i.cast("string")).alias("cust_name"),
            F.lit(spec.default_tier).alias("segment"),
            F.date_sub(F.lit(spec.as_of), days_ago).alias("signup_date"),
        ),
        CUSTOMERS,
    )


def gen_transactions(spark: SparkSession, spec: GenSpec = GenSpec()) -> DataFrame:
    i = F.col("id")
    uniform_customer = F.lit(1) + _u(i, spec.seed, 3) % F.lit(spec.customers)
    if spec.hot_share > 0:
        hot = (_u(i, spec.seed, 7) % F.lit(1_000_000)) < F.lit(int(spec.hot_share * 1_000_000))
        customer = F.when(hot, F.lit(1).cast("bigint")).otherwise(uniform_customer)
    else:
        customer = uniform_customer
    return conform(
        _range(spark, spec.transactions, spec.partitions).select(
            i.alias("txn_id"),
            customer.alias("customer_id"),
            (F.lit(1) + _u(i, spec.seed, 4) % F.lit(spec.products)).alias("product_id"),
            (F.lit(1) + _u(i, spec.seed, 5) % F.lit(5)).cast("int").alias("quantity"),
            F.date_sub(F.lit(spec.as_of), (_u(i, spec.seed, 6) % F.lit(366)).cast("int")).alias("txn_date"),
        ),
        SALES_TRANSACTIONS,
    )


def generate(spark: SparkSession, spec: GenSpec = GenSpec()) -> dict[str, DataFrame]:
    return {
        "products": gen_products(spark, spec),
        "customers": gen_customers(spark, spec),
        "sales_transactions": gen_transactions(spark, spec),
    }

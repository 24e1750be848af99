"""Declared schemas of the three-table star (customers, products,
sales_transactions) and the validation report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

PRICE = DecimalType(10, 2)

CUSTOMERS = StructType(
    [
        StructField("customer_id", LongType(), True),
        StructField("cust_name", StringType(), True),
        StructField("segment", StringType(), True),
        StructField("signup_date", DateType(), True),
    ]
)

PRODUCTS = StructType(
    [
        StructField("product_id", LongType(), True),
        StructField("product_name", StringType(), True),
        StructField("category", StringType(), True),
        StructField("unit_price", PRICE, True),
    ]
)

SALES_TRANSACTIONS = StructType(
    [
        StructField("txn_id", LongType(), True),
        StructField("customer_id", LongType(), True),
        StructField("product_id", LongType(), True),
        StructField("quantity", IntegerType(), True),
        StructField("txn_date", DateType(), True),
    ]
)

REPORT = StructType(
    [
        StructField("Check_Category", StringType(), True),
        StructField("Check_Item", StringType(), True),
        StructField("Actual", StringType(), True),
        StructField("Expected", StringType(), True),
        StructField("Status", StringType(), True),
    ]
)

TABLE_SCHEMAS = {
    "customers": CUSTOMERS,
    "products": PRODUCTS,
    "sales_transactions": SALES_TRANSACTIONS,
}

TABLE_COMMENTS = {
    "customers": "One row per customer: name, spend tier, day of signing up",
    "products": "One row per product: name, category, price",
    "sales_transactions": "One row per sold line: who, what, how many, when",
}


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select and cast to a declared schema (explicit casts: an int key is
    widened to bigint here, never silently by the writer)."""
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])

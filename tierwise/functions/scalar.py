"""Scalar helpers: deterministic codes, string and date functions, column
defaults.  All built-in Spark expressions (JVM side, whole-stage codegen);
no Python UDF."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Per-character multipliers of the code generator.
CODE_MULTIPLIERS = (31, 37, 41, 43, 47, 53, 59, 61)


def code_of(key: Column, multipliers: tuple[int, ...] = CODE_MULTIPLIERS) -> Column:
    """An uppercase code, one letter per multiplier, computed from ``key``
    (the deterministic stand-in for a random string)."""
    parts = [F.char(F.lit(65) + F.pmod(key * F.lit(m) + F.lit(17 * i), F.lit(26))) for i, m in enumerate(multipliers)]
    return F.concat(*parts)


def sql_code_of(key: str, multipliers: tuple[int, ...] = CODE_MULTIPLIERS) -> str:
    parts = [f"chr(CAST(65 + ((({key}) * {m} + {17 * i}) % 26 + 26) % 26 AS INTEGER))" for i, m in enumerate(multipliers)]
    return "concat(" + ", ".join(parts) + ")"


def with_default(df: DataFrame, column: str, default) -> DataFrame:
    """Column DEFAULT applied on read: NULL -> ``default``."""
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(default)))


def string_functions(customers: DataFrame) -> DataFrame:
    """customer_id plus upper, lower, length, substring, regexp_extract,
    instr and trim of the customer name."""
    n = F.col("cust_name")
    return customers.select(
        "customer_id",
        F.upper(n).alias("name_upper"),
        F.lower(n).alias("name_lower"),
        F.length(n).alias("name_length"),
        F.substring(n, 1, 8).alias("name_prefix"),
        F.regexp_extract(n, r"([0-9]+)$", 1).alias("name_number"),
        F.instr(n, "#").alias("hash_pos"),
        F.trim(F.concat(F.lit("  "), n, F.lit("  "))).alias("name_trimmed"),
    )


def whole_months_between(end: Column, start: Column) -> Column:
    """floor(months_between(end, start)) - whole months between two dates."""
    return F.floor(F.months_between(end, start)).cast("int")


def date_functions(customers: DataFrame, as_of: dt.date) -> DataFrame:
    """customer_id, signup_date and date arithmetic against ``as_of``."""
    s = F.col("signup_date")
    a = F.lit(as_of)
    return customers.select(
        "customer_id",
        "signup_date",
        F.date_add(s, 30).alias("plus_30_days"),
        F.date_sub(s, 7).alias("minus_7_days"),
        F.datediff(a, s).alias("days_since_signup"),
        whole_months_between(a, s).alias("whole_months_since_signup"),
        F.trunc(s, "MM").alias("signup_month"),
        F.last_day(s).alias("signup_month_end"),
        F.add_months(s, 1).alias("plus_one_month"),
    )

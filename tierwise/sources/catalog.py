"""Catalog set-up (namespace, typed tables with comments) and table
metadata.  Plain parquet tables: identity columns, constraints and MERGE
are table-format features, handled by the generator (keys), the quality
checks (PK/FK) and ``operators.merge``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwise.schemas import TABLE_COMMENTS, TABLE_SCHEMAS, conform


def create_namespace(spark: SparkSession, db: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}`")


def drop_tables(spark: SparkSession, db: str) -> None:
    """Drop for a clean state, fact table first."""
    for name in ("sales_transactions", "products", "customers"):
        spark.sql(f"DROP TABLE IF EXISTS `{db}`.`{name}`")


def create_tables(spark: SparkSession, db: str) -> None:
    """CREATE TABLE for the three tables with their declared types."""
    for name, schema in TABLE_SCHEMAS.items():
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS `{db}`.`{name}` ({cols}) USING parquet COMMENT '{TABLE_COMMENTS[name]}'"
        )


def append(spark: SparkSession, db: str, name: str, df: DataFrame) -> None:
    """Append rows, cast to the declared schema first (no silent widening)."""
    conform(df, TABLE_SCHEMAS[name]).write.mode("append").insertInto(f"`{db}`.`{name}`")


def save_bucketed(df: DataFrame, db: str, name: str, key: str, buckets: int | None = None) -> None:
    """Save ``df`` as a catalog table bucketed and sorted by ``key``.

    With ``buckets`` equal to ``spark.sql.shuffle.partitions`` (the
    default), Spark reads the table as already hash-partitioned by ``key``:
    a join with an aggregate grouped by ``key`` - every per-customer spend -
    then moves only the aggregate side, never the table."""
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.mode("overwrite").bucketBy(n, key).sortBy(key).saveAsTable(f"`{db}`.`{name}`")


def truncate(spark: SparkSession, db: str, name: str) -> None:
    spark.sql(f"TRUNCATE TABLE `{db}`.`{name}`")


def describe_tables(spark: SparkSession, db: str) -> DataFrame:
    """table_name, column_name, data_type for every table of ``db``
    (catalog metadata: one row per column)."""
    rows = []
    for t in spark.catalog.listTables(db):
        for c in spark.catalog.listColumns(f"`{db}`.`{t.name}`"):
            rows.append((t.name, c.name, c.dataType))
    return spark.createDataFrame(rows, "table_name string, column_name string, data_type string")


def table_detail(df: DataFrame, name: str) -> DataFrame:
    """table_name, num_rows, num_files, size_bytes of a file-based table
    (files without a row aren't seen).

    Each row knows its file and the file's size (``_metadata``); they are
    grouped by file on the executors, so no list of files passes through the
    driver."""
    files = df.groupBy("_metadata.file_path").agg(F.count(F.lit(1)).alias("n"), F.max("_metadata.file_size").alias("size"))
    return files.agg(
        F.lit(name).alias("table_name"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("num_rows"),
        F.count(F.lit(1)).alias("num_files"),
        F.coalesce(F.sum("size"), F.lit(0)).cast("bigint").alias("size_bytes"),
    )

"""Stored tables: write to a new path, then read it.

A table is a folder of versions ``v=000001``, ``v=000002``, ...  A write goes
to a new version folder; Spark's commit protocol leaves ``_SUCCESS`` only
when the whole job committed, and readers take the newest version that has
it.  So a table is never overwritten while it is being read, and a failed
write leaves the previous version in place.  One writer at a time.

File-system calls use the session's Hadoop ``FileSystem``, so the same code
works on a local folder, HDFS or an object store.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tierwise.operators.merge import action_counts, merged_rows


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, version: int) -> str:
        return f"{self.root}/v={version:06d}"

    def _started(self) -> list[int]:
        """Versions whose write began."""
        if not self._fs.exists(self._path(self.root)):
            return []
        names = [st.getPath().getName() for st in self._fs.listStatus(self._path(self.root)) if st.isDirectory()]
        return sorted(int(n[2:]) for n in names if n.startswith("v="))

    def versions(self) -> list[int]:
        """Committed versions, oldest first."""
        return [v for v in self._started() if self._fs.exists(self._path(f"{self.path(v)}/_SUCCESS"))]

    def current_version(self) -> int | None:
        committed = self.versions()
        return committed[-1] if committed else None

    def read(self, version: int | None = None) -> DataFrame:
        v = self.current_version() if version is None else version
        if v is None:
            raise FileNotFoundError(f"no committed version under {self.root}")
        return self.spark.read.parquet(self.path(v))

    def write(
        self, df: DataFrame, partition_by: list[str] | None = None, cluster_by: list[str] | None = None
    ) -> int:
        """Write ``df`` as the next version.

        ``partition_by`` lays out folders per value (partition pruning);
        ``cluster_by`` range-partitions and sorts the rows by those columns
        first, so parquet row-group min/max statistics skip data on filters
        over them.  With both, the range partitions are cut along the folder
        columns, so a folder gets few files and a large one several tasks."""
        return self._commit(_clustered(df, partition_by, cluster_by), partition_by)

    def _commit(self, df: DataFrame, partition_by: list[str] | None) -> int:
        started = self._started()
        v = (started[-1] if started else 0) + 1
        w = df.write.mode("errorifexists")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(self.path(v))
        return v

    def write_counted(
        self, df: DataFrame, partition_by: list[str] | None = None, cluster_by: list[str] | None = None
    ) -> tuple[int, int]:
        """``write``, and the number of rows written, from the same job."""
        seen = Observation()
        rows = _clustered(df, partition_by, cluster_by).observe(seen, F.count(F.lit(1)).alias("rows"))
        return self._commit(rows, partition_by), seen.get["rows"]

    def write_merged(
        self, tagged: DataFrame, partition_by: list[str] | None = None, cluster_by: list[str] | None = None
    ) -> tuple[int, dict[str, int]]:
        """Write the rows of ``operators.merge.merge`` that stay, and return
        the version with the rows of every action, deletes included, from the
        same job.  The rows are counted behind the range exchange, whose
        sampling job would count them a second time."""
        seen = Observation()
        rows = merged_rows(_clustered(tagged, partition_by, cluster_by).observe(seen, *action_counts()))
        return self._commit(rows, partition_by), dict(seen.get)


def _clustered(df: DataFrame, partition_by: list[str] | None, cluster_by: list[str] | None) -> DataFrame:
    lead = [*(partition_by or []), *(cluster_by or [])]
    return df.repartitionByRange(*lead).sortWithinPartitions(*lead) if cluster_by else df


def with_month_partitions(df: DataFrame, date_col: str = "txn_date") -> DataFrame:
    """Add ``txn_year`` / ``txn_month`` derived from a date column, the
    folder layout for a large fact table."""
    return df.withColumn("txn_year", F.year(date_col)).withColumn("txn_month", F.month(date_col))


def since(df: DataFrame, first_day: dt.date, date_col: str = "txn_date") -> DataFrame:
    """Rows from ``first_day`` on; where the table has month folders, the
    earlier ones aren't read."""
    if {"txn_year", "txn_month"} <= set(df.columns):
        y, m = first_day.year, first_day.month
        df = df.where((F.col("txn_year") > y) | ((F.col("txn_year") == y) & (F.col("txn_month") >= m)))
    return df.where(F.col(date_col) >= F.lit(first_day))


class StarStore:
    """The three tables of the star, each a ``VersionedTable`` under one
    root, plus a versioned folder for change sets."""

    NAMES = ("customers", "products", "sales_transactions")

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.tables = {n: VersionedTable(spark, f"{self.root}/{n}") for n in (*self.NAMES, "tier_changes")}

    def __getitem__(self, name: str) -> VersionedTable:
        return self.tables[name]

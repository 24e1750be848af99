"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import os
import shutil
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwise.session import ensure_checkpoint_dir

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table of the data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder the cluster names in
    ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark)}/tierwise-llm/{name}-{uuid.uuid4().hex}"


def spill(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts the
    lineage, survives lost executors, and later stages scan only the columns
    they use."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Intermediate tables of one job, in a folder of their own below the
    shared one; leaving the block deletes them."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.path, self.made = spark, shared_path(spark, name), 0

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def spill(self, df: DataFrame) -> DataFrame:
        """Like :func:`spill`, until the block is left."""
        self.made += 1
        path = f"{self.path}/{self.made}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def ascii_lower(c: Column) -> Column:
    """Lower-cases A-Z only; every other character stays as it is."""
    return F.translate(c, UPPER, LOWER)


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Place of a public vocabulary file."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


_SHIPPED: set[str] = set()


def map_batches(df: DataFrame, run, schema) -> DataFrame:
    """``mapInArrow``, after the package has been given to the executors'
    Python once per application (``addPyFile``), so that workers need no
    installed copy and no particular working directory."""
    sc = df.sparkSession.sparkContext
    if sc.applicationId not in _SHIPPED:
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(), "tierwise"), "zip", root, "tierwise")
        sc.addPyFile(archive)
        _SHIPPED.add(sc.applicationId)
    return df.mapInArrow(run, schema)


def pieces(batch: pa.RecordBatch, limit: int, *columns: str):
    """Cuts a batch so that the texts of a piece stay within ``limit`` bytes
    (one row at least); no text is unpacked for it."""
    sizes = np.zeros(batch.num_rows, np.int64)
    for c in columns:
        sizes += pc.fill_null(pc.binary_length(batch.column(c)), 0).to_numpy(zero_copy_only=False)
    ends, at = np.cumsum(sizes), 0
    while at < len(sizes):
        stop = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + limit, side="right"))
        stop = max(at + 1, stop)
        yield batch.slice(at, stop - at)
        at = stop


def tidy() -> None:
    """Gives a worker's free memory back; workers are used again by later
    stages, whose peaks would otherwise add up."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not on this platform
        pass

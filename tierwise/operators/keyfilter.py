"""Runtime filter: the keys of a filtered dimension, as a bit table of bounded
size, drop fact rows where they are read.

A semi join keeps the same rows, but beyond the broadcast threshold it
shuffles the whole fact for it.  Here every key sets one bit (its hash modulo
the table's size); a fact row whose bit is not set has no partner and goes
before any exchange.  Rows of other keys that share a bit stay, so the join
itself still follows.

The table is a scalar subquery: Spark runs it before the scan and hands it to
the tasks.  Its size is ``bits`` / 8 bytes whatever the number of keys, at most
``MAX_BITS`` / 8 = 16 MB; with more keys than bits it only lets more rows
through.  A NULL key never joins, so it goes; a dimension without rows drops
all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_BITS, MAX_BITS = 1 << 16, 1 << 27
_WORD = 64


def _bit(key: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(bits))


def bits_for(keys: int) -> int:
    """A table for that many keys: eight bits a key, within the bounds (about
    one other key in eight passes)."""
    bits = MIN_BITS
    while bits < MAX_BITS and bits < 8 * keys:
        bits *= 2
    return bits


def estimated_rows(df: DataFrame) -> int:
    """Rows by Spark's own size estimate; only the size of a bit table, never
    a result, depends on it."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(str(stats.sizeInBytes())) // 8


def key_bits(dim: DataFrame, key: str, bits: int) -> DataFrame:
    """One row, ``words``: the bit table as longs.  Words are combined in
    every partition before the exchange; empty ones come from a range."""
    if not MIN_BITS <= bits <= MAX_BITS or bits & (bits - 1):
        raise ValueError(f"bits must be a power of two from {MIN_BITS} to {MAX_BITS}")
    at = _bit(F.col(key), bits)
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), (at % _WORD).cast("int"))
    used = dim.where(F.col(key).isNotNull()).select((at / _WORD).cast("bigint").alias("word"), one.alias("set"))
    empty = dim.sparkSession.range(bits // _WORD).select(F.col("id").alias("word"), F.lit(0).cast("bigint").alias("set"))
    words = used.unionByName(empty).groupBy("word").agg(F.bit_or("set").alias("set"))
    return words.agg(F.sort_array(F.collect_list(F.struct("word", "set"))).alias("words")).select(F.col("words.set").alias("words"))


def keep_keys(fact: DataFrame, dim: DataFrame, key: str, bits: int | None = None) -> DataFrame:
    """The rows of ``fact`` whose ``key`` may be in ``dim``: all that are, and
    of the others those that share a bit with one.  ``key`` has one type on
    both sides.  ``bits`` follows the estimated size of ``dim`` if not given."""
    if fact.schema[key].dataType != dim.schema[key].dataType:
        raise TypeError(f"{key} has different types on both sides")
    bits = bits or bits_for(estimated_rows(dim.select(key)))
    at = _bit(F.col(key), bits)
    word = F.get(key_bits(dim, key, bits).scalar(), (at / _WORD).cast("int"))
    return fact.where(F.col(key).isNotNull() & (F.getbit(word, (at % _WORD).cast("int")) == 1))

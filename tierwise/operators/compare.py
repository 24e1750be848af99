"""Compare two versions of a keyed table: counts, per-row status, changed
columns.

Both tables are dealt into buckets by a hash of their key, and each bucket
gets a fingerprint that no row order changes: the row count, and the exclusive
or and the sum of two 64-bit hashes of its rows.  Buckets with equal
fingerprints hold the same rows (but for a chance of about 2^-100), so only
rows of the other buckets are shuffled and joined; between equal tables none
are.  Fingerprints are combined in every partition first, one row a bucket,
so their number bounds what is broadcast.

Both sides are read twice: store a computed side before comparing it.

Defined cases: values compare NULL-safely; a NULL in a key matches nothing, so
such rows are always ``only_left`` or ``only_right``; keys should be unique, as
rows that share one are joined pairwise where their bucket differs; columns of one side
alone don't count.  Columns of map type can't be compared.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def compare_rows(left: DataFrame, right: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """key columns plus ``status``: same / changed / only_left / only_right.
    Values compare NULL-safely (NULL equals NULL)."""
    keys = [key] if isinstance(key, str) else list(key)
    values = [c for c in left.columns if c not in keys and c in right.columns]
    lt = left.select(*keys, *[F.col(c).alias(f"_l_{c}") for c in values], F.lit(True).alias("_l"))
    rt = right.select(*keys, *[F.col(c).alias(f"_r_{c}") for c in values], F.lit(True).alias("_r"))
    j = lt.join(rt, keys, "full_outer")
    same = F.lit(True)
    for c in values:
        same = same & F.col(f"_l_{c}").eqNullSafe(F.col(f"_r_{c}"))
    status = (
        F.when(F.col("_r").isNull(), F.lit("only_left"))
        .when(F.col("_l").isNull(), F.lit("only_right"))
        .when(same, F.lit("same"))
        .otherwise(F.lit("changed"))
    )
    return j.select(*keys, status.alias("status"))


_BUCKET, _LOOSE = "_bucket", -1  # rows with a NULL in the key are in no bucket


def _keys_of(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _bucketed(df: DataFrame, keys: Sequence[str], columns: Sequence[str], buckets: int) -> DataFrame:
    whole = reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys))
    bucket = F.when(whole, F.pmod(F.xxhash64(*keys), F.lit(buckets))).otherwise(F.lit(_LOOSE))
    return df.select(*columns, bucket.cast("int").alias(_BUCKET))


def _fingerprints(df: DataFrame, columns: Sequence[str], side: str) -> DataFrame:
    # a hash skips NULLs, so it is told which columns are NULL
    parts = [*columns, *[F.col(c).isNull() for c in columns]]
    exact = F.sum(F.xxhash64(F.lit(1), *parts).cast("decimal(20,0)"))
    of_bucket = F.struct(F.count(F.lit(1)).alias("rows"), F.bit_xor(F.xxhash64(*parts)).alias("mixed"), exact.alias("total"))
    return df.where(F.col(_BUCKET) != _LOOSE).groupBy(_BUCKET).agg(of_bucket.alias(side))


def _split(left: DataFrame, right: DataFrame, keys: list[str], buckets: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Fingerprints of both sides by bucket (``same``: equal), and the rows of
    each side that have to be joined."""
    columns = [c for c in left.columns if c in right.columns]
    sides = [_bucketed(df, keys, columns, buckets) for df in (left, right)]
    prints = _fingerprints(sides[0], columns, "l").join(_fingerprints(sides[1], columns, "r"), _BUCKET, "full_outer")
    prints = prints.select(_BUCKET, F.col("l").eqNullSafe(F.col("r")).alias("same"), F.col("l.rows").alias("rows"))
    loose = left.sparkSession.range(1).select(F.lit(_LOOSE).alias(_BUCKET))
    differing = prints.where(~F.col("same")).select(_BUCKET).unionByName(loose)
    # at most ``buckets`` + 1 rows
    rows = [side.join(F.broadcast(differing), _BUCKET, "left_semi").drop(_BUCKET) for side in sides]
    return prints, *rows


def compare_tables(left: DataFrame, right: DataFrame, key: str | Sequence[str], buckets: int = 1 << 16) -> DataFrame:
    """status, row_count."""
    prints, lt, rt = _split(left, right, _keys_of(key), buckets)
    joined = compare_rows(lt, rt, key).groupBy("status").agg(F.count(F.lit(1)).alias("row_count"))
    equal = prints.where("same").agg(F.lit("same").alias("status"), F.sum("rows").alias("row_count"))
    both = joined.unionByName(equal).groupBy("status").agg(F.sum("row_count").alias("row_count"))
    return both.where(F.col("row_count") > 0)


def compare_columns(left: DataFrame, right: DataFrame, key: str | Sequence[str], buckets: int = 1 << 16) -> DataFrame:
    """column, changed, became_null, was_null - for every column but the key:
    rows of both sides whose values differ, and of these the ones whose new
    and whose old value is NULL."""
    keys = _keys_of(key)
    values = [c for c in left.columns if c not in keys and c in right.columns]
    _, lt, rt = _split(left, right, keys, buckets)
    rt = rt.select(*keys, *[F.col(c).alias(f"_r_{c}") for c in values])
    pairs = lt.join(rt, keys, "inner")
    changed = [F.struct(
        F.lit(c).alias("column"), (~F.col(c).eqNullSafe(F.col(f"_r_{c}"))).alias("changed"),
        F.col(f"_r_{c}").isNull().alias("now"), F.col(c).isNull().alias("before"),
    ) for c in values]
    if not changed:
        return left.sparkSession.createDataFrame([], "column string, changed bigint, became_null bigint, was_null bigint")
    # every column has a row, also where nothing differs
    none = left.sparkSession.createDataFrame([(c, False, False, False) for c in values], "column string, changed boolean, now boolean, before boolean")
    rows = pairs.select(F.explode(F.array(*changed)).alias("v")).select("v.*").unionByName(none)
    return rows.groupBy("column").agg(
        F.count_if("changed").alias("changed"), F.count_if(F.col("changed") & F.col("now")).alias("became_null"),
        F.count_if(F.col("changed") & F.col("before")).alias("was_null"),
    )

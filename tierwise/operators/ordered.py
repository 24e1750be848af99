"""Order-dependent operators that stay balanced under any key skew.

A window partitioned by a key sends every row of that key to one task; if
one customer or category holds a third of the data, so does one task.  The
operators here never do that:

1. ``orderBy`` - Spark's range-partitioned sort; the range bounds are sampled
   over the whole sort key, so a hot group is cut across many partitions.
   The sorted rows are stored as columnar files with their partition and row
   number, so an executor loss cannot reshuffle them.
2. Windows run within (partition, group), which is at most one sorted
   partition's rows.
3. What crosses a partition boundary is a carry: one row per partition
   (a bounded table) says how the partition begins and ends.  The carries are
   chained in one small window and joined back as a broadcast.

* ``global_row_number``  - 1..n over the total order (surrogate keys),
* ``lag_within``         - previous row of the same group,
* ``row_number_within``  - ROW_NUMBER() per group,
* ``rank_within``        - RANK() per group,
* ``numbers_of_smallest`` - the row numbers of a few rows, by counting alone.

All of it is DataFrame expressions, so every type keeps its exact values.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierwise.session import ensure_checkpoint_dir

PART, ROW, CARRY = "_part", "_row", "_carry"


def _order_cols(cols: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def _keys(cols: Sequence[str]) -> Column:
    """The key columns as one value; NULLs in it compare as equal."""
    return F.struct(*[F.col(c) for c in cols])


def sorted_partitions(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """``df`` range-sorted by ``order`` plus ``_part`` (its partition) and
    ``_row`` (ascending in the order), written once as Parquet to the
    checkpoint folder: the passes that only need the carries read their
    columns alone."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/sorted-{uuid.uuid4().hex}"
    numbered = df.orderBy(*_order_cols(order)).select("*", F.monotonically_increasing_id().alias(ROW))
    numbered = numbered.select("*", F.shiftright(ROW, 33).alias(PART))
    numbered.write.parquet(path)
    return spark.read.schema(numbered.schema).parquet(path)


def _with_carry(ck: DataFrame, carries: DataFrame) -> DataFrame:
    """One row per partition joined to the sorted rows."""
    return ck.join(F.broadcast(carries.select(PART, CARRY)), PART, "left")


def _by_part() -> Window:
    """Over one row per partition."""
    return Window.orderBy(PART)


def global_row_number(df: DataFrame, order: Sequence[Column | str], name: str = "row_num") -> DataFrame:
    """ROW_NUMBER() OVER (ORDER BY order) without a single-task window;
    ``order`` must be a total order (rows that tie in it are interchangeable)."""
    ck = sorted_partitions(df, order)
    sizes = ck.groupBy(PART).agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(_by_part().rowsBetween(Window.unboundedPreceding, -1))
    placed = _with_carry(ck, sizes.withColumn(CARRY, F.coalesce(before, F.lit(0))))
    local = F.col(ROW) - F.shiftleft(F.col(PART), 33)
    return placed.select(*df.columns, (F.col(CARRY) + local + 1).alias(name))


def numbers_of_smallest(
    df: DataFrame, wanted: DataFrame, order: Sequence[str], k: int, name: str, lead: str | None = None
) -> DataFrame:
    """The ``k`` smallest rows of ``wanted``, a part of ``df``, with the number
    that ``global_row_number(df, order)`` gives them (ascending, NULLs first),
    found without sorting or storing ``df``.

    The ``k`` rows are a top-k of every partition; then one pass counts the
    rows of ``df`` below each of them, at most ``k`` + 1 groups.  A row of
    ``df`` that equals one in ``wanted`` must be in ``wanted`` itself, so rows
    that tie are numbered one after another.  ``lead`` names the first order
    column where it is never NULL: its bound then reaches the scan.
    No rows in ``wanted``, or ``k`` below 1: no rows."""
    if k < 1:
        return wanted.limit(0).withColumn(name, F.lit(None).cast("bigint"))
    key = F.struct(*[F.col(c) for c in order])
    head = wanted.orderBy(*[F.col(c).asc_nulls_first() for c in order]).limit(k)
    # k rows as one value: a subquery that Spark runs once for all its uses
    top = head.agg(F.collect_list(F.struct(*[F.col(c) for c in wanted.columns])).alias("top")).scalar()
    head = df.sparkSession.range(1).select(F.explode(top).alias("top")).select("top.*")
    keys = head.agg(F.sort_array(F.collect_set(key)).alias("keys"))
    reach = df
    if lead:
        reach = reach.where(F.col(lead) <= head.agg(F.max(lead)).scalar())
    # the first of the keys that a row doesn't exceed; a row beyond all of them has none
    at = F.filter(F.col("_keys"), lambda wanted_key: wanted_key >= F.col("_key"))
    counted = (
        reach.select(key.alias("_key"), keys.scalar().alias("_keys"))
        .select(F.get(at, F.lit(0)).alias("_at"), "_key")
        .where(F.col("_at").isNotNull())
        .groupBy("_at").agg(F.count_if(F.col("_key") < F.col("_at")).alias("below"), F.count_if(F.col("_key") == F.col("_at")).alias("equal"))
    )
    so_far = F.sum(F.col("below") + F.col("equal")).over(Window.orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    starts = counted.select("_at", (so_far - F.col("equal")).alias("_before"))
    ties = F.row_number().over(Window.partitionBy("_key").orderBy("_key"))
    placed = head.withColumn("_key", key).withColumn("_tie", ties)
    return placed.join(starts, F.col("_key").eqNullSafe(F.col("_at")), "inner").select(
        *wanted.columns, (F.col("_before") + F.col("_tie")).alias(name)
    )


def lag_within(
    df: DataFrame, group: Sequence[str], order: Sequence[Column | str], value: str, name: str
) -> DataFrame:
    """LAG(value) OVER (PARTITION BY group ORDER BY order) as ``name``.
    ``group + order`` must be a total order."""
    ck = sorted_partitions(df, [*group, *order])
    ends = ck.groupBy(PART).agg(F.max_by(F.struct(_keys(group).alias("keys"), F.col(value).alias("value")), ROW).alias("end"))
    placed = _with_carry(ck, ends.withColumn(CARRY, F.lag("end").over(_by_part())))
    w = Window.partitionBy(PART, *group).orderBy(ROW)
    begins = F.row_number().over(w) == 1
    carried = F.when(_keys(group) == F.col(f"{CARRY}.keys"), F.col(f"{CARRY}.value"))
    return placed.select(*df.columns, F.when(begins, carried).otherwise(F.lag(value).over(w)).alias(name))


def _numbered(ck: DataFrame, group: Sequence[str], name: str) -> DataFrame:
    """Sorted rows plus their ROW_NUMBER() within the group.

    A partition that begins inside a group continues from the rows of that
    group in the partitions before it; all of them end with that group, so
    their trailing runs add up to the carry."""
    runs = ck.groupBy(PART, *group).agg(F.count(F.lit(1)).alias("n"), F.max(ROW).alias("at"))
    runs = runs.select(PART, "at", "n", _keys(group).alias("keys"))
    ends = runs.groupBy(PART).agg(
        F.min_by("keys", "at").alias("first"), F.max_by("keys", "at").alias("last"), F.max_by("n", "at").alias("tail")
    )
    so_far = F.sum("tail").over(Window.partitionBy("last").orderBy(PART))
    chained = ends.withColumn("so_far", so_far).withColumn("end", F.struct("last", "so_far"))
    prev = F.lag("end").over(_by_part())
    chained = chained.withColumn("prev", prev).withColumn(
        CARRY, F.when(F.col("prev.last") == F.col("first"), F.struct(F.col("first").alias("keys"), F.col("prev.so_far").alias("rows")))
    )
    w = Window.partitionBy(PART, *group).orderBy(ROW)
    offset = F.when(_keys(group) == F.col(f"{CARRY}.keys"), F.col(f"{CARRY}.rows")).otherwise(F.lit(0))
    return _with_carry(ck, chained).select(*ck.columns, (F.row_number().over(w) + offset).alias(name))


def row_number_within(
    df: DataFrame, group: Sequence[str], order: Sequence[Column | str], name: str = "row_num"
) -> DataFrame:
    """ROW_NUMBER() OVER (PARTITION BY group ORDER BY order) as ``name``;
    ``group + order`` must be a total order."""
    ck = sorted_partitions(df, [*group, *order])
    return _numbered(ck, group, name).select(*df.columns, name)


def rank_within(
    df: DataFrame, group: Sequence[str], order: Sequence[Column | str], tie: Sequence[str], extra: Sequence[Column | str], name: str
) -> DataFrame:
    """RANK() OVER (PARTITION BY group ORDER BY order) as ``name``.

    ``tie`` are the columns whose equality makes a tie (the ORDER BY
    columns); ``extra`` completes ``order`` to a total order.  A row's rank is
    the group row number of the first row of its tie run, which may lie in an
    earlier partition."""
    ck = sorted_partitions(df, [*group, *order, *extra])
    run = [*group, *tie]
    rows = _numbered(ck, group, "_rn")
    runs = rows.groupBy(PART, *run).agg(F.min("_rn").alias("start"), F.max(ROW).alias("at"))
    runs = runs.select(PART, "at", "start", _keys(run).alias("keys"))
    ends = runs.groupBy(PART).agg(
        F.min_by("keys", "at").alias("first"), F.max_by("keys", "at").alias("last"), F.max_by("start", "at").alias("start")
    )
    earliest = F.min("start").over(Window.partitionBy("last").orderBy(PART))
    chained = ends.withColumn("end", F.struct(F.col("last"), earliest.alias("start")))
    chained = chained.withColumn("prev", F.lag("end").over(_by_part())).withColumn(
        CARRY, F.when(F.col("prev.last") == F.col("first"), F.struct(F.col("first").alias("keys"), F.col("prev.start").alias("start")))
    )
    here = F.min("_rn").over(Window.partitionBy(PART, *run))
    ranked = F.when(_keys(run) == F.col(f"{CARRY}.keys"), F.col(f"{CARRY}.start")).otherwise(here)
    return _with_carry(rows, chained).select(*df.columns, ranked.alias(name))

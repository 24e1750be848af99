"""Keyed MERGE on plain DataFrames (no transactional table format needed).

``merge`` returns every output row tagged with ``_action``:

    update  - target row matched a source row and an update clause fired
    delete  - target row matched and a delete clause fired (kept in the
              tagged output so it can be counted; ``merged_rows`` drops it)
    insert  - source row with no target row, insert clause present
    keep    - target row left as it was

Semantics follow the usual MERGE: clauses for matched rows are tried in
order, first match wins; it is an error if clauses fire for two source rows
on the same target row.  Source rows whose clauses don't fire never matter,
and every source row without a target row - repeated keys and NULL keys
included - is inserted.

A source is computed once: it is checkpointed (``keyed_source`` needs no
copy), so that all clauses see the same source rows even where its plan is
not repeatable, and a lost executor costs no second run of it.  It is grouped
by key once (one shuffle, with a map-side partial aggregate, so a hot key
costs one row per partition).  Target rows whose key has one source row, the
usual case, are decided by that one join, which may split a hot target key;
only those whose key has several are joined to the source rows themselves.

``merge_metrics`` counts the actions of a merge on their own;
``action_counts`` are the same counts for ``observe``, so that the job which
writes the merged table delivers them (``VersionedTable.write_merged``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwise.session import ensure_checkpoint_dir

ACTION = "_action"
_N = "_s_rows"
_COPIES = "_t_copies"
_AMBIGUOUS = "MERGE: more than one source row acts on one target row"
ACTIONS = ("update", "insert", "delete", "keep")


@dataclass(frozen=True)
class WhenMatched:
    """``update`` maps target column -> expression over ``s.<col>`` /
    ``t.<col>``; ``delete=True`` makes it a delete clause."""

    update: Mapping[str, Column] | None = None
    condition: Column | None = None
    delete: bool = False


@dataclass(frozen=True)
class WhenNotMatched:
    values: Mapping[str, Column]
    condition: Column | None = None


def _keys(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def _same(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, (F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys))


def _fired(matched: Sequence[WhenMatched], here: Column) -> Column:
    """Number of the first clause that fires for a joined row, else NULL."""
    number = F.lit(None).cast("int")
    for i, clause in reversed(list(enumerate(matched))):
        holds = here if clause.condition is None else here & F.coalesce(clause.condition, F.lit(False))
        number = F.when(holds, F.lit(i)).otherwise(number)
    return number


def _decided(joined: DataFrame, target: DataFrame, matched: Sequence[WhenMatched], fired: str) -> list[Column]:
    """Target columns after the clause ``fired``, and the action."""
    cols = []
    for c in target.columns:
        value = F.col(f"t.{c}")
        for i, clause in enumerate(matched):
            if clause.update and c in clause.update:
                value = F.when(F.col(fired) == i, clause.update[c]).otherwise(value)
        cols.append(value.cast(target.schema[c].dataType).alias(c))
    action = F.lit("keep")
    for i, clause in enumerate(matched):
        action = F.when(F.col(fired) == i, F.lit("delete" if clause.delete else "update")).otherwise(action)
    return [*cols, action.alias(ACTION)]


def merge(
    target: DataFrame,
    source: DataFrame,
    on: str | Sequence[str],
    matched: Sequence[WhenMatched] = (),
    not_matched: WhenNotMatched | None = None,
    keyed_source: bool = False,
) -> DataFrame:
    """``keyed_source``: the source has one row per key by construction, so
    a key with several is an error, and the source is read once without a
    copy of it."""
    keys = _keys(on)
    if not keyed_source:
        ensure_checkpoint_dir(source.sparkSession)
        source = source.checkpoint()
    values = [c for c in source.columns if c not in keys]
    per_key = source.groupBy(*keys).agg(F.count(F.lit(1)).alias(_N), *[F.first(c).alias(c) for c in values])
    joined = target.alias("t").join(per_key.alias("s"), _same(keys), "left")
    several = F.coalesce(F.col(f"s.{_N}") > 1, F.lit(False))
    act = _fired(matched, F.col(f"s.{_N}").isNotNull())
    if keyed_source:
        act = F.when(several, F.raise_error(F.lit(_AMBIGUOUS)).cast("int")).otherwise(act)
        single = joined
    else:
        single = joined.where(~several)
    single = single.withColumn("_fired", act)
    out = single.select(*_decided(single, target, matched, "_fired"))
    if not keyed_source:
        out = out.unionByName(_crowded(joined.where(several), target, source, keys, matched))
    if not_matched is not None:
        out = out.unionByName(_inserted(target, source, keys, not_matched))
    return out


def _crowded(rows: DataFrame, target: DataFrame, source: DataFrame, keys: Sequence[str], matched: Sequence[WhenMatched]) -> DataFrame:
    """Target rows whose key has several source rows: equal target rows are
    one row with a number of copies, each is tried against every source row
    of its key, and at most one may act."""
    own = rows.select(*[F.col(f"t.{c}").alias(c) for c in target.columns]).groupBy(*target.columns).agg(F.count(F.lit(1)).alias(_COPIES))
    pairs = own.alias("t").join(source.alias("s"), _same(keys), "inner")
    pairs = pairs.withColumn("_fired", _fired(matched, F.lit(True)))
    *after, action = _decided(pairs, target, matched, "_fired")
    before = [F.col(f"t.{c}").alias(f"_b{i}") for i, c in enumerate(target.columns)]
    pairs = pairs.select(*before, F.col(f"t.{_COPIES}").alias(_COPIES), F.when(F.col("_fired").isNotNull(), F.struct(*after, action)).alias("_done"))
    names = [f"_b{i}" for i in range(len(target.columns))]
    tried = pairs.groupBy(*names, _COPIES).agg(F.count("_done").alias("_acting"), F.first("_done", ignorenulls=True).alias("_done"))
    kept = F.struct(*[F.col(b).alias(c) for b, c in zip(names, target.columns)], F.lit("keep").alias(ACTION))
    done = F.when(F.col("_acting") > 1, F.raise_error(F.lit(_AMBIGUOUS)).cast(tried.schema["_done"].dataType)).otherwise(F.coalesce("_done", kept))
    copies = F.sequence(F.lit(1).cast("bigint"), F.col(_COPIES))
    return tried.select(done.alias("_done"), F.explode(copies).alias("_copy")).select("_done.*")


def _inserted(target: DataFrame, source: DataFrame, keys: Sequence[str], clause: WhenNotMatched) -> DataFrame:
    """Source rows without a target row (a NULL key has none)."""
    new = source.alias("s").join(target.select(*keys).alias("t"), _same(keys), "left_anti")
    if clause.condition is not None:
        new = new.where(F.coalesce(clause.condition, F.lit(False)))
    cols = [clause.values.get(c, F.lit(None)).cast(target.schema[c].dataType).alias(c) for c in target.columns]
    return new.select(*cols, F.lit("insert").alias(ACTION))


def merged_rows(tagged: DataFrame) -> DataFrame:
    """The new table: tagged rows minus deletes, without the tag."""
    return tagged.where(F.col(ACTION) != "delete").drop(ACTION)


def action_counts() -> list[Column]:
    """One count per action over tagged rows, for ``observe``."""
    return [F.count_if(F.col(ACTION) == name).alias(name) for name in ACTIONS]


def merge_metrics(tagged: DataFrame) -> DataFrame:
    """action, row_count - counts of updated / inserted / deleted / kept rows."""
    return tagged.groupBy(F.col(ACTION).alias("action")).agg(F.count(F.lit(1)).alias("row_count"))


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """DELETE FROM df WHERE condition: rows where it is NULL stay."""
    return df.where(~F.coalesce(condition, F.lit(False)))

"""Mixing sources to target weights by Poisson replication.

Each source has a mean repetition rate: its target share of the mixture over
its present share, both measured in characters (or documents).  A document's
number of copies is drawn from a Poisson distribution with that mean by
inverting its distribution function at a uniform number hashed from the seed
and the document's id, so a rerun, a retry or another partitioning draws the
same copies.  The copies are exploded and shuffled globally by a hashed key.

Rates above ``PART`` are split into equal parts of at most ``PART`` whose
independent draws are added, which is the same distribution and bounds the
table that is inverted.

Only DataFrame expressions are used.  The per-source table is joined as a
broadcast only if it has at most ``MAX_BROADCAST_SOURCES`` rows; beyond that
a shuffle join on the source and a salt takes its place.

Defined cases: a null source is a source of its own; sources missing from
``weights`` get weight ``other`` (0 drops them); without ``weights`` all
sources are weighted alike; null texts measure 0 characters; where the whole
measure is 0 every rate is 0; a null ``doc_id`` is hashed as the empty
string; repeated rows draw the same number of copies; columns of ``docs``
are carried, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwise.llm.common import spill

PART = 16.0
#: terms of the distribution function kept for a part; P(X > TERMS) < 1e-17
TERMS = 64
MAX_BROADCAST_SOURCES = 10_000
SALTS = 64
#: uniform numbers have 48 bits
_GRID = float(1 << 48)


def _hash48(*cols: Column) -> Column:
    """48 bits of the MD5 of the joined columns, as a double."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *cols)), 1, 12), 16, 10).cast("double")


def rates(docs: DataFrame, weights: dict | None = None, other: float = 0.0, measure: str = "chars") -> DataFrame:
    """``source_key, rate``: mean number of copies of a source's documents.
    The expected size of the mixture is the size of ``docs``."""
    size = F.length("text") if measure == "chars" else F.lit(1)
    per = docs.groupBy(_key(F.col("source"))).agg(F.coalesce(F.sum(size), F.lit(0)).cast("double").alias("own"))
    if weights is None:
        wanted = F.lit(1.0)
    else:
        wanted = F.lit(float(other))
        for source, w in weights.items():
            wanted = F.when(F.col("source_key") == _name(source), F.lit(float(w))).otherwise(wanted)
    per = spill(per.withColumn("wanted", F.when(F.col("own") > 0, wanted).otherwise(F.lit(0.0))), "sources")
    total = per.agg(F.sum("own").alias("own"), F.sum("wanted").alias("wanted")).first()
    if not total["own"] or not total["wanted"]:
        return per.select("source_key", F.lit(0.0).alias("rate"))
    rate = F.col("wanted") / F.lit(total["wanted"]) * F.lit(total["own"]) / F.col("own")
    return per.select("source_key", F.when(F.col("own") > 0, rate).otherwise(F.lit(0.0)).alias("rate"))


def _name(source) -> str:
    return "?" if source is None else "=" + str(source)


def _key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("?")).alias("source_key")


def _steps(rate: DataFrame) -> DataFrame:
    """Adds the number of parts of each rate and a part's distribution
    function: ``steps[i] = P(X <= i)``, term i being term i-1 times mean/i."""
    parts = F.greatest(F.lit(1), F.ceil(F.col("rate") / PART)).cast("int")
    mean = rate.withColumn("parts", parts).withColumn("mean", F.col("rate") / F.col("parts"))
    begin = F.struct(F.exp(-F.col("mean")).alias("term"), F.exp(-F.col("mean")).alias("sum"), F.array(F.exp(-F.col("mean"))).alias("cdf"))

    def add(s, i):
        term = s["term"] * F.col("mean") / i
        return F.struct(term.alias("term"), (s["sum"] + term).alias("sum"), F.array_append(s["cdf"], s["sum"] + term).alias("cdf"))

    steps = F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), begin, add, lambda s: s["cdf"])
    return mean.select("source_key", "rate", "parts", steps.alias("steps"))


def replicate(docs: DataFrame, weights: dict | None = None, other: float = 0.0, measure: str = "chars", seed: int = 17) -> DataFrame:
    """``doc, rate, copies, copy_no, shuffle_key``: each row of ``docs`` (as
    the struct ``doc``) repeated by its drawn number of copies, with the key
    of the global shuffle, which isn't applied yet."""
    table = spill(_steps(rates(docs, weights, other, measure)), "rates")
    keyed = docs.select(F.struct(*docs.columns).alias("doc"), _key(F.col("source")), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"))
    if table.limit(MAX_BROADCAST_SOURCES + 1).count() <= MAX_BROADCAST_SOURCES:
        joined = keyed.join(F.broadcast(table), "source_key")
    else:
        salted = keyed.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
        spread = table.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
        joined = salted.join(spread, ["source_key", "salt"])

    def draw(part):
        u = (_hash48(F.lit(str(seed)), part.cast("string"), F.col("id")) + 0.5) / _GRID
        return F.size(F.filter("steps", lambda p: p < u))

    copies = F.aggregate(F.sequence(F.lit(1), F.col("parts")), F.lit(0), lambda n, part: n + draw(part))
    counted = joined.withColumn("copies", F.when(F.col("rate") > 0, copies).otherwise(F.lit(0))).where("copies > 0")
    out = counted.withColumn("copy_no", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    key = F.md5(F.concat_ws("|", F.lit(f"order{seed}"), F.col("copy_no").cast("string"), F.col("id")))
    return out.select("doc", "rate", "copies", "copy_no", key.alias("shuffle_key"))


def mix(docs: DataFrame, weights: dict | None = None, other: float = 0.0, measure: str = "chars", seed: int = 17) -> DataFrame:
    """The mixture in its shuffled order, with the columns of ``docs``."""
    return replicate(docs, weights, other, measure, seed).orderBy("shuffle_key", "doc.doc_id").select("doc.*")


def store(docs: DataFrame, weights: dict | None = None, other: float = 0.0, measure: str = "chars", seed: int = 17) -> DataFrame:
    """The rows of :func:`replicate`, whole documents, written to the shared
    folder in their shuffled order (of the files, and of the rows of each)."""
    return spill(replicate(docs, weights, other, measure, seed).orderBy("shuffle_key", "doc.doc_id"), "mixture")


#: DuckDB form of the query over ``documents`` (weights alike, characters)
ORACLE = """
WITH RECURSIVE per AS (
  SELECT coalesce('=' || source, '?') AS k, CAST(coalesce(sum(length(text)), 0) AS DOUBLE) AS own
  FROM documents GROUP BY 1
), total AS (
  SELECT sum(own) AS all_own, CAST(count(*) FILTER (WHERE own > 0) AS DOUBLE) AS n FROM per
), lam AS (
  SELECT k, CASE WHEN own > 0 AND n > 0 THEN 1.0::DOUBLE / n * all_own / own ELSE 0.0::DOUBLE END AS rate FROM per, total
), split AS (
  SELECT k, rate, CAST(greatest(1, ceil(rate / 16.0::DOUBLE)) AS INT) AS parts FROM lam
), cdf AS (
  SELECT k, rate, parts, rate / parts AS mean, 0 AS i, exp(-(rate / parts)) AS term, exp(-(rate / parts)) AS p FROM split
  UNION ALL
  SELECT k, rate, parts, mean, i + 1, term * mean / (i + 1), p + term * mean / (i + 1) FROM cdf WHERE i < 64
), steps AS (
  SELECT k, rate, parts, list(p ORDER BY i) AS p FROM cdf GROUP BY k, rate, parts
), drawn AS (
  SELECT d.doc_id, d.source, s.rate, list_sum(list_transform(range(1, s.parts + 1), lambda part:
    len(list_filter(s.p, lambda p: p < (CAST(('0x' || substr(md5('17|' || part || '|' || coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 12)) AS BIGINT)
      + 0.5::DOUBLE) / 281474976710656.0::DOUBLE)))) AS n
  FROM documents d JOIN steps s ON coalesce('=' || d.source, '?') = s.k
)
SELECT doc_id, source, CAST(n AS INT) AS copies, CAST(c AS INT) AS copy_no,
  md5('order17|' || c || '|' || coalesce(CAST(doc_id AS VARCHAR), '')) AS shuffle_key
FROM drawn, unnest(range(1, CAST(CASE WHEN rate > 0 THEN n ELSE 0 END AS BIGINT) + 1)) AS u(c)
"""

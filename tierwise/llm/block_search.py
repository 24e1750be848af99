"""Ranked lexical search with per-term geometric blocking.

Every document becomes a vector of exact integer contributions (weight of the
term times its saturated frequency) over the terms that are asked for.
Documents are ordered by similarity: a bounded, documented sample of ``pivots``
documents makes the clusters, the whole table is range-partitioned by cluster
(a hot cluster spans many partitions), and each shard of at most
``shard_postings`` postings is clustered again by pivots of its own.  In a
shard, every term's posting list is cut into blocks of similar documents, and
a block keeps the coordinatewise maximum of its documents' vectors.

The sum of a block's maxima over an item's terms bounds the score of all its
documents for the item.  Blocks are visited by falling bound; they are skipped
only when the bound is below the score of the item's ``k``-th best document so
far in the partition, so results are those of an exhaustive search.  A
document is scored once, from its whole vector.  The index lives as long as
its shard is searched.

Items are searched in parts of at most ``max_terms`` terms, so what the tasks
hold is bounded; documents without any term asked for have no vector but count
in the statistics.

Defined cases: a null text has no terms; items without terms, and terms no
document holds, give no rows; rows of one ``item_id`` are one item, as are
those with null; every document row is ranked, equal scores by ``doc_id``
(null first); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tierwise.llm.common import Scratch, map_batches, pieces, spill, tidy

K = 50
BLOCK = 64
PIVOTS = 64
SHARD_POSTINGS = 1 << 20
MAX_TERMS = 500_000
BATCH = 4 << 20
#: entries of block summaries that are built at a time
SUMMARY = 1 << 21

# fixed values: ASCII letters and digits and every other character above ASCII belong to terms
_TERM_BYTES = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)

HITS = "item bigint, doc_id bigint, row bigint, score bigint"


def terms(text: str | None) -> list[bytes]:
    """Terms of a text as UTF-8, with repeats."""
    return text.encode().translate(_TERM_BYTES).split() if text else []


def vectors(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``doc_id, n, terms, tfs``: all terms counted, those of the vocabulary
    with their frequencies."""

    def run(batches):
        known = vocabulary.get
        for whole in batches:
            for b in pieces(whole, BATCH, "text"):
                n, ids, tfs = [], [], []
                for text in b.column("text").to_pylist():
                    words = terms(text)
                    found = Counter(map(known, words))
                    found.pop(None, None)
                    n.append(len(words))
                    ids.append(list(found))
                    tfs.append(list(found.values()))
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64()))], ["doc_id", "n", "terms", "tfs"]
                )
        tidy()

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_batches(texts, run, "doc_id long, n long, terms array<int>, tfs array<long>")


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Vectors:
    """Contributions of documents: row ``i`` is ``cols, vals[ptr[i]:ptr[i+1]]``."""

    def __init__(self, ptr, cols, vals):
        self.ptr, self.cols, self.vals = ptr, cols, vals

    @classmethod
    def of(cls, batch: pa.RecordBatch, weights, n_docs: int, length: int) -> Vectors:
        lists = batch.column("terms")
        sizes = np.diff(lists.offsets.to_numpy())
        cols = lists.flatten().to_numpy().astype(np.int64)
        tf = batch.column("tfs").flatten().to_numpy()
        n = batch.column("n").to_numpy()
        m = np.repeat(50 + 50 * n * n_docs // max(length, 1), sizes)
        vals = weights[cols] * (1_000_000_000 * tf // (1000 * tf + 20 * m))
        return cls(np.concatenate(([0], np.cumsum(sizes))), cols, vals)

    @classmethod
    def join(cls, parts: list[Vectors]) -> Vectors:
        sizes = np.concatenate([np.diff(p.ptr) for p in parts])
        return cls(np.concatenate(([0], np.cumsum(sizes))), np.concatenate([p.cols for p in parts]), np.concatenate([p.vals for p in parts]))

    def places(self, rows) -> tuple[np.ndarray, np.ndarray]:
        """Entries of some rows, and where each row begins among them."""
        sizes = self.ptr[rows + 1] - self.ptr[rows]
        begin = np.concatenate(([0], np.cumsum(sizes)))[:-1]
        return np.repeat(self.ptr[rows] - begin, sizes) + np.arange(int(sizes.sum())), begin

    def take(self, rows) -> Vectors:
        at, _ = self.places(rows)
        sizes = self.ptr[rows + 1] - self.ptr[rows]
        return Vectors(np.concatenate(([0], np.cumsum(sizes))), self.cols[at], self.vals[at])

    def nearest(self, pivots: Vectors) -> tuple[np.ndarray, np.ndarray]:
        """The pivot of largest cosine of each row, and this cosine."""
        n, k = len(self.ptr) - 1, len(pivots.ptr) - 1
        if not k:
            return np.zeros(n, np.int64), np.zeros(n)
        used, where = np.unique(pivots.cols, return_inverse=True)
        dense = np.zeros((len(used) + 1, k), np.float32)
        dense[where, np.repeat(np.arange(k), np.diff(pivots.ptr))] = pivots.vals
        dense /= np.maximum(np.linalg.norm(dense, axis=0), 1e-9)
        slot = np.searchsorted(used, self.cols)
        slot[(slot == len(used)) | (used[np.minimum(slot, len(used) - 1)] != self.cols)] = len(used)
        best, cosine = np.zeros(n, np.int64), np.zeros(n)
        norms = np.sqrt(np.add.reduceat(np.append(self.vals.astype(np.float64) ** 2, 0.0), self.ptr[:-1])) if n else np.zeros(0)
        for i in range(n):
            lo, hi = self.ptr[i], self.ptr[i + 1]
            if lo < hi:
                score = self.vals[lo:hi].astype(np.float32) @ dense[slot[lo:hi]]
                best[i] = score.argmax()
                cosine[i] = score[best[i]] / max(norms[i], 1e-9)
        return best, cosine


class Shard:
    """Posting lists of some documents in blocks, with their summaries' bounds
    for every item."""

    def __init__(self, vecs: Vectors, ids, asked: dict[int, list[int]], items: list[np.ndarray], width: int, block: int):
        n = len(vecs.ptr) - 1
        own, cosine = vecs.nearest(vecs.take(np.unique(np.linspace(0, n - 1, max(1, math.isqrt(n))).astype(np.int64))))
        order = np.lexsort((-cosine, own))
        self.vecs, self.ids, own = vecs.take(order), [x[order] for x in ids], own[order]
        self.width = width
        rows = np.repeat(np.arange(n), np.diff(self.vecs.ptr))
        by_term = np.argsort(self.vecs.cols, kind="stable")
        held, first = np.unique(self.vecs.cols[by_term], return_index=True)
        #: of each item: bounds, and the documents, of its terms' blocks
        self.blocks: dict[int, list[tuple[np.ndarray, list[np.ndarray]]]] = {}
        for term, at, to in zip(held, first, [*first[1:], len(by_term)], strict=True):
            posted = rows[by_term[at:to]]
            change = np.flatnonzero(np.diff(own[posted])) + 1
            ends = [0, *change, len(posted)]
            starts = np.array([s for lo, hi in zip(ends, ends[1:], strict=False) for s in range(lo, hi, block)])
            docs_of = np.split(posted, starts[1:])
            bounds = self._bounds(posted, starts, [items[q] for q in asked[term]])
            for q, bound in zip(asked[term], bounds, strict=True):
                self.blocks.setdefault(q, []).append((bound, docs_of))

    def _bounds(self, posted, starts, wanted: list[np.ndarray]) -> list[np.ndarray]:
        """Per item, the sums of the blocks' coordinatewise maxima."""
        step = max(1, SUMMARY // self.width)
        out = [[] for _ in wanted]
        ends = [*starts[1:], len(posted)]
        for lo in range(0, len(starts), step):
            some = starts[lo : lo + step]
            members = posted[some[0] : ends[min(lo + step, len(starts)) - 1]]
            block_of = np.searchsorted(some, np.arange(some[0], some[0] + len(members)), side="right") - 1
            at, _ = self.vecs.places(members)
            key = np.repeat(block_of, self.vecs.ptr[members + 1] - self.vecs.ptr[members]) * self.width + self.vecs.cols[at]
            summary = np.zeros(len(some) * self.width, np.int64)
            np.maximum.at(summary, key, self.vecs.vals[at])
            summary = summary.reshape(len(some), self.width)
            for bounds, cols in zip(out, wanted, strict=True):
                bounds.append(summary[:, cols].sum(axis=1))
        return [np.concatenate(b) for b in out]

    def search(self, q: int, cols: np.ndarray, best: Best) -> int:
        """Offers the documents of all blocks that may reach ``best``;
        returns how many blocks were skipped."""
        lists = self.blocks.get(q)
        if not lists:
            return 0
        bounds = np.concatenate([b for b, _ in lists])
        docs_of = [d for _, ds in lists for d in ds]
        order = np.argsort(-bounds, kind="stable")
        wanted = np.zeros(self.width, bool)
        wanted[cols] = True
        seen = np.zeros(len(self.vecs.ptr) - 1, bool)
        at, step = 0, 4
        while at < len(order):
            some = order[at : at + step]
            some = some[bounds[some] >= best.floor()]
            if not len(some):
                break
            rows = np.unique(np.concatenate([docs_of[i] for i in some]))
            rows = rows[~seen[rows]]
            seen[rows] = True
            if len(rows):
                places, begin = self.vecs.places(rows)
                scores = np.add.reduceat(np.where(wanted[self.vecs.cols[places]], self.vecs.vals[places], 0), begin)
                best.offer(scores, *(x[rows] for x in self.ids))
            at, step = at + step, step * 2
        return max(0, len(order) - at)


class Best:
    """The ``k`` best documents of an item."""

    def __init__(self, k: int):
        self.k = k
        self.rows = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)]

    def floor(self) -> int:
        """Scores below this one can't get in."""
        return int(self.rows[0][-1]) if len(self.rows[0]) == self.k else 1

    def offer(self, scores, doc_id, is_null, row) -> None:
        able = scores >= self.floor()
        if able.any():
            score, doc_id, is_null, row = (np.concatenate((a, b[able])) for a, b in zip(self.rows, (scores, doc_id, is_null, row), strict=True))
            order = np.lexsort((row, doc_id, ~is_null, -score))[: self.k]
            self.rows = [x[order] for x in (score, doc_id, is_null, row)]


def search(docs: DataFrame, items: DataFrame, k: int = K, block: int = BLOCK, pivots: int = PIVOTS,
           shard_postings: int = SHARD_POSTINGS, max_terms: int = MAX_TERMS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of each item."""
    spark = docs.sparkSession
    with Scratch(spark, "block-search") as scratch:
        asked = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))

        def run(batches):
            for whole in batches:
                for b in pieces(whole, BATCH, "text"):
                    found = [sorted(set(terms(t))) for t in b.column("text").to_pylist()]
                    yield pa.RecordBatch.from_arrays([b.column("item_id"), pa.array(found, pa.list_(pa.binary()))], ["item_id", "terms"])

        pairs = map_batches(asked, run, "item_id long, terms array<binary>").select("item_id", F.explode("terms").alias("term")).distinct()
        # rows of one item stay together
        pairs = scratch.spill(pairs)
        parts = max(1, -(-pairs.count() // max_terms))
        found = [
            _search_part(docs, pairs.where(F.pmod(F.xxhash64(F.coalesce("item_id", F.lit(-1)), F.col("item_id").isNull()), F.lit(parts)) == p), k, block, pivots, shard_postings, scratch)
            for p in range(parts)
        ]
        hits = found[0]
        for more in found[1:]:
            hits = hits.union(more)
        return spill(hits, "block-hits")


def _search_part(docs, pairs, k, block, pivots, shard_postings, scratch) -> DataFrame:
    spark = docs.sparkSession
    wanted: dict[int | None, list[bytes]] = {}
    for r in pairs.toLocalIterator():
        wanted.setdefault(r.item_id, []).append(bytes(r.term))
    names = list(wanted)
    vocabulary = {t: i for i, t in enumerate(sorted({t for ts in wanted.values() for t in ts}))}
    items = [np.array(sorted(vocabulary[t] for t in wanted[name]), np.int64) for name in names]
    asked: dict[int, list[int]] = {}
    for q, cols in enumerate(items):
        for c in cols.tolist():
            asked.setdefault(c, []).append(q)
    width = max(1, len(vocabulary))

    # rows are numbered after they are stored, so a repeated task numbers them alike
    vecs = scratch.spill(vectors(docs, vocabulary)).withColumn("row", F.monotonically_increasing_id())
    n_docs, length = vecs.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    weights = np.zeros(width, np.int64)
    for r in vecs.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator():  # a row per term asked for
        weights[r["term"]] = max(0, weight(n_docs, r["count"]))
    held = vecs.where(F.size("terms") > 0)

    sample = held.orderBy(F.xxhash64("row"), "row").limit(pivots).select("n", "terms", "tfs").toArrow()
    centres = [Vectors.of(b, weights, n_docs, length) for b in sample.combine_chunks().to_batches()]
    centres = Vectors.join(centres) if centres else Vectors(np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))

    def place(batches):
        for b in batches:
            cluster, _ = Vectors.of(b, weights, n_docs, length).nearest(centres)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cluster, pa.int64())], [*b.schema.names, "cluster"])

    def run(batches):
        best = [Best(k) for _ in names]
        got, size = [], 0

        def flush():
            whole = Vectors.join([g[0] for g in got])
            ids = [np.concatenate([g[1][i] for g in got]) for i in range(3)]
            shard = Shard(whole, ids, asked, items, width, block)
            for q in shard.blocks:
                shard.search(q, items[q], best[q])

        for whole in batches:
            for b in (whole.slice(i, 256) for i in range(0, whole.num_rows, 256)):
                doc_id = b.column("doc_id")
                ids = (doc_id.fill_null(0).to_numpy(zero_copy_only=False), doc_id.is_null().to_numpy(zero_copy_only=False), b.column("row").to_numpy())
                got.append((Vectors.of(b, weights, n_docs, length), ids))
                size += len(got[-1][0].cols)
                if size >= shard_postings:
                    flush()
                    got, size = [], 0
        if got:
            flush()
        for q, b in enumerate(best):
            score, doc_id, is_null, row = b.rows
            if len(score):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(score), q)), pa.array(doc_id, mask=is_null), pa.array(row), pa.array(score)], ["item", "doc_id", "row", "score"]
                )
        tidy()

    placed = map_batches(held.select("doc_id", "n", "terms", "tfs", "row"), place, "doc_id long, n long, terms array<int>, tfs array<long>, row long, cluster long")
    near = scratch.spill(placed).repartitionByRange("cluster", F.xxhash64("row")).sortWithinPartitions("cluster")
    hits = map_batches(near.select("doc_id", "n", "terms", "tfs", "row"), run, HITS)
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_first(), "row")
    top = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    keys = spark.createDataFrame([(q, name) for q, name in enumerate(names)], "item long, item_id long")
    return scratch.spill(top.join(F.broadcast(keys), "item").select("item_id", "rank", "doc_id", "score"))


ORACLE = r"""
WITH doc_terms AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents
), tf AS (SELECT doc_id, term, count(*) AS tf FROM doc_terms GROUP BY ALL),
lens AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id),
tot AS (SELECT count(*) AS nd, sum(n)::BIGINT AS l FROM lens),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), w AS (SELECT term, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, tot GROUP BY term, nd),
scored AS (
  SELECT item_id, doc_id, sum(w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 20 * (50 + (50 * n * nd) // l))))::BIGINT AS score
  FROM asked JOIN tf USING (term) JOIN w USING (term) JOIN lens USING (doc_id), tot GROUP BY item_id, doc_id
), ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM scored WHERE score > 0
) SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""

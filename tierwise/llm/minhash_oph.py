"""Near-duplicate classes by one-permutation hashing.

A document's set of word shingles is hashed once; the hash range is cut into
bins and each bin keeps its smallest hash.  Empty bins are densified: an
empty bin copies the first non-empty bin of its own fixed random order, which
makes each bin an independent draw.  Groups of bins form bands; documents
that agree on a band share a bucket.

Documents with equal sets are merged into one class first, so a group of
exact copies is one point.  Candidate edges are stars: the members of a
bucket are paired with its heads, the smallest members in each of ``HEADS``
global random orders, so a bucket of m classes gives at most ``HEADS * m``
pairs, and a group that agrees on many bands keeps meeting the same heads.  A
member's heads are gathered over all of its buckets before they become pairs,
so such a pair is made once and not once for each band.  A bucket of at most
``SMALL`` classes gives all of its pairs instead.  Candidates are confirmed on
the full sets and linked into components.

Larger buckets whose members still lie in different components may hide a
link between two members of which neither is a head.  Their members - and
only these - go through an exact set join instead of a comparison of all
pairs: shingles ordered by their frequency among these members, rarest
first, with prefix, length and positional filters; pairs that pass and lie in
different components are confirmed on the full sets.  So no link between two
members of a bucket is lost.

With 40 bands of 6 bins a pair at the threshold 0.8 shares no bucket with
probability 5e-6; more similar pairs far less.

Defined cases: a document without words has the empty set and is linked with
nothing; so is one whose ``doc_id`` is null (``component_id`` null, kept).
Rows that repeat a ``doc_id`` are one document.  Other columns are ignored by
:func:`near_duplicates`; :func:`drop_near_duplicates` carries them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwise.llm.common import Scratch, map_batches, pieces, spill, tidy

BANDS, ROWS = 40, 6
HEADS = 8
#: members of a bucket that gives all of its pairs
SMALL = HEADS + 1
BINS = BANDS * ROWS
_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1 << 63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_PLACE = _rng.integers(1 << 63, size=64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = _rng.integers(1 << 63, size=ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BAND = _rng.integers(1 << 63, size=BANDS, dtype=np.uint64)
_BOUNDS = np.array([(i << 64) // BINS for i in range(1, BINS)], dtype=np.uint64)
#: the order in which an empty bin asks the others
_ORDER = np.argsort(np.argsort(_rng.random((BINS, BINS)), axis=1), axis=1).astype(np.int16)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
PIECE = 2_000_000


def _mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.concatenate(([np.uint64(1)], np.full(n, _STEP))))


_POW = _powers(64)


def shingle_sets(texts: list, size: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's word shingles; words are
    runs without ASCII white space, A-Z lower-cased; a text of fewer words
    has the whole sequence as its one shingle."""
    raws = [(t or "").encode("utf-8", "replace") for t in texts]
    data = _LOWER[np.frombuffer(b" ".join(raws) + b" ", np.uint8)]
    gap = _SPACE[data]
    begin = np.flatnonzero(~gap & np.concatenate(([True], gap[:-1])))
    stop = np.flatnonzero(gap & np.concatenate(([False], ~gap[:-1])))
    ends = np.cumsum([len(r) + 1 for r in raws])
    if not len(begin):
        return [np.zeros(0, np.uint64)] * len(raws)
    length = stop - begin
    place = np.arange(len(data)) - np.repeat(begin, np.diff(np.append(begin, len(data)))) if begin[0] == 0 else None
    if place is None:
        place = np.zeros(len(data), np.int64)
        place[begin[0] :] = np.arange(begin[0], len(data)) - np.repeat(begin, np.diff(np.append(begin, len(data))))
    global _POW
    if (longest := int(length.max())) >= len(_POW):
        _POW = _powers(2 * longest)
    with np.errstate(over="ignore"):
        value = _BYTE[data] * _POW[np.minimum(place, len(_POW) - 1)]
        value[gap] = 0
        words = _mix(np.add.reduceat(value, begin) + length.astype(np.uint64) * _STEP)
        bounds = np.searchsorted(begin, ends)
        n = len(words)
        rolled = np.zeros(n, np.uint64)
        for i in range(min(size, n)):
            rolled[: n - i] += words[i:] * _PLACE[i]
        rolled = _mix(rolled)
        out, lo = [], 0
        for hi in bounds.tolist():
            if hi - lo >= size:
                out.append(np.unique(rolled[lo : hi - size + 1]))
            elif hi > lo:
                short = np.uint64(hi - lo)
                for i in range(hi - lo):
                    short += words[lo + i] * _PLACE[i + 32]
                out.append(_mix(np.array([short])))
            else:
                out.append(np.zeros(0, np.uint64))
            lo = hi
    return out


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """Bucket keys of a sorted set of hashes, one for each band."""
    cut = np.concatenate(([0], np.searchsorted(hashes, _BOUNDS), [len(hashes)]))
    full = cut[1:] > cut[:-1]
    value = np.zeros(BINS, np.uint64)
    used = np.flatnonzero(full)
    value[used] = hashes[cut[used]]
    empty = np.flatnonzero(~full)
    if len(empty):
        value[empty] = value[used[_ORDER[np.ix_(empty, used)].argmin(axis=1)]]
    with np.errstate(over="ignore"):
        return _mix((value.reshape(BANDS, ROWS) * _MIX).sum(axis=1, dtype=np.uint64) + _BAND).view(np.int64)


def _set_key(hashes: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a whole set."""
    with np.errstate(over="ignore"):
        a, b = hashes.sum(dtype=np.uint64), _mix(hashes ^ _STEP).sum(dtype=np.uint64)
    return int(a.view(np.int64)), int(b.view(np.int64))


def signatures(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """``doc_id, n_shingles, set_a, set_b, bands`` per row."""

    def run(batches):
        for whole in batches:
            for b in pieces(whole, PIECE, "text"):
                sets = shingle_sets(b.column("text").to_pylist(), shingle)
                keys = [_set_key(s) for s in sets]
                bands = [band_keys(s) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array([k[0] for k in keys], pa.int64()),
                     pa.array([k[1] for k in keys], pa.int64()), pa.array(bands, pa.list_(pa.int64()))],
                    ["doc_id", "n_shingles", "set_a", "set_b", "bands"],
                )
        tidy()

    return map_batches(_texts(docs), run, "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def confirm(pairs: DataFrame, docs: DataFrame, shingle: int) -> DataFrame:
    """``a, b, shared, total``: sizes of the intersection and the union of
    the two full sets of each pair."""

    def run(batches):
        for whole in batches:
            for b in pieces(whole, PIECE, "text_a", "text_b"):
                left = shingle_sets(b.column("text_a").to_pylist(), shingle)
                right = shingle_sets(b.column("text_b").to_pylist(), shingle)
                shared = [len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(left, right, strict=True)]
                total = [len(x) + len(y) - s for x, y, s in zip(left, right, shared, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [b.column("a"), b.column("b"), pa.array(shared, pa.int64()), pa.array(total, pa.int64())], ["a", "b", "shared", "total"]
                )
        tidy()

    text = _texts(docs)
    both = (
        pairs.join(text.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
        .join(text.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
        .select("a", "b", "text_a", "text_b")
    )
    sizes = map_batches(both, run, "a long, b long, shared long, total long")
    # an id with several texts gives several rows; the most similar counts
    best = F.max_by(F.struct("shared", "total"), F.try_divide("shared", "total"))
    return sizes.groupBy("a", "b").agg(best.alias("s")).select("a", "b", "s.shared", "s.total")


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``node, root`` of every node of an undirected graph, the root being
    the smallest node of its component: alternating large-star and small-star
    rounds, each written to the shared folder."""
    cur = scratch.spill(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct())
    state = None
    while True:
        both = cur.union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u and v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(low.select("u", F.col("m").alias("v"))).distinct()
        )
        cur = scratch.spill(small)
        seen = cur.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if tuple(seen) == state:
            return cur.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = tuple(seen)


def _linked(checked: DataFrame, percent: int) -> DataFrame:
    return checked.where(F.expr(f"total > 0 and 100 * shared >= {percent} * total"))


def near_duplicates(docs: DataFrame, shingle: int = 4, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row."""
    with Scratch(docs.sparkSession, "near-duplicates") as scratch:
        return spill(_classes_of(docs, shingle, percent, scratch), "near-duplicates")


def _classes_of(docs: DataFrame, shingle: int, percent: int, scratch: Scratch) -> DataFrame:
    sig = scratch.spill(signatures(docs, shingle))
    key = ["n_shingles", "set_a", "set_b"]
    known = sig.where("n_shingles > 0 and doc_id is not null")
    classes = scratch.spill(known.groupBy(*key).agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands")))

    every = classes.select("rep", F.explode("bands").alias("bucket"))
    shared = every.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    members = scratch.spill(every.join(shared, "bucket"))
    same_id = _shared_ids(known, classes, key)
    links = same_id

    def add(pairs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Confirms candidate pairs: their similarities, all links so far,
        and the components these make."""
        sims = scratch.spill(confirm(pairs, docs, shingle))
        more = links.union(_linked(sims, percent).select(F.col("a").alias("u"), F.col("b").alias("v")))
        return sims, more, components(more, scratch)

    _, links, roots = add(_candidates(members))
    large = members.where(F.col("n") > SMALL)
    apart = _apart(large, roots, scratch)
    if not apart.isEmpty():
        _, links, roots = add(_exact_pairs(apart, docs, shingle, percent, scratch))

    owner = classes.select(*key, "rep").join(roots, F.col("rep") == F.col("node"), "left").select(
        *key, F.coalesce("root", "rep").alias("component_id")
    )
    out = known.select("doc_id", *key).join(owner, key).select("doc_id", "n_shingles", "component_id")
    if not same_id.isEmpty():
        low = out.groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
        out = out.select("doc_id", "n_shingles").join(low, "doc_id")
    rest = sig.where("n_shingles = 0 or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return out.select("doc_id", "n_shingles", "component_id").union(rest).select(
        "doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")
    )


def _shared_ids(known: DataFrame, classes: DataFrame, key: list[str]) -> DataFrame:
    """Edges between the classes of one ``doc_id`` that has several texts."""
    twice = known.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
    if twice.isEmpty():
        return known.sparkSession.createDataFrame([], "u long, v long")
    reps = known.join(twice, "doc_id").select("doc_id", *key).join(classes.select(*key, "rep"), key).select("doc_id", "rep")
    return reps.select(F.col("doc_id").alias("u"), F.col("rep").alias("v")).distinct()


def _head(seed: int):
    """A bucket's smallest member in one of the random orders."""
    return F.min(F.struct(F.xxhash64("rep", F.lit(seed)).alias("h"), "rep"))["rep"]


def _stars(members: DataFrame, seeds) -> DataFrame:
    """Each member of a bucket paired with the bucket's heads."""
    heads = members.groupBy("bucket").agg(F.array_sort(F.array_distinct(F.array(*(_head(s) for s in seeds)))).alias("heads"))
    # the buckets of a group have mostly the same heads: a member's heads are gathered over its
    # buckets, at most one array for each band, before any pair is made
    met = members.join(heads, "bucket").groupBy("rep").agg(F.array_distinct(F.flatten(F.collect_set("heads"))).alias("heads"))
    pairs = met.select("rep", F.explode("heads").alias("head")).where("rep != head")
    return pairs.select(F.least("rep", "head").alias("a"), F.greatest("rep", "head").alias("b")).distinct()


def _candidates(members: DataFrame) -> DataFrame:
    """All pairs of the small buckets and the stars of the others."""
    reps = members.where(F.col("n") <= SMALL).groupBy("bucket").agg(F.collect_set("rep").alias("reps"))
    pairs = reps.select("reps", F.explode("reps").alias("a")).select("a", F.explode(F.filter("reps", lambda b: b > F.col("a"))).alias("b"))
    return pairs.union(_stars(members.where(F.col("n") > SMALL), range(HEADS))).distinct()


def _apart(members: DataFrame, roots: DataFrame, scratch: Scratch) -> DataFrame:
    """``rep, root``: the members, with their components, of the buckets
    that hold more than one."""
    placed = members.join(roots.select(F.col("node").alias("rep"), "root"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    mixed = placed.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo != hi").select("bucket")
    return scratch.spill(placed.join(mixed, "bucket").select("rep", "root").distinct())


def _exact_pairs(apart: DataFrame, docs: DataFrame, shingle: int, percent: int, scratch: Scratch) -> DataFrame:
    """Pairs of these documents that lie in different components and pass
    the filters of the exact set join."""

    def run(batches):
        for whole in batches:
            for b in pieces(whole, PIECE, "text"):
                sets = [s.view(np.int64) for s in shingle_sets(b.column("text").to_pylist(), shingle)]
                sizes = pa.array([len(s) for s in sets], pa.int64())
                yield pa.RecordBatch.from_arrays([b.column("rep"), b.column("root"), sizes, pa.array(sets, pa.list_(pa.int64()))], ["rep", "root", "n", "tokens"])

    text = _texts(docs).select(F.col("doc_id").alias("rep"), "text").join(apart, "rep").select("rep", "root", "text")
    sets = map_batches(text, run, "rep long, root long, n long, tokens array<long>").where("n > 0")
    tokens = scratch.spill(sets.select("rep", "root", "n", F.explode("tokens").alias("token")))
    often = tokens.groupBy("token").agg(F.count("*").alias("f")).where("f > 1")
    # a token of one document alone can't match, it only takes a place at the front
    own = tokens.join(often, "token").groupBy("rep", "root", "n").agg(F.sort_array(F.collect_list(F.struct("f", "token"))).alias("shared"))
    alone = F.col("n") - F.size("shared")
    probe = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    index = F.col("n") - F.ceil(F.col("n") * 2 * percent / (100 + percent)) + 1
    front = F.expr("slice(shared, 1, cast(greatest(0, probe - alone) as int))")
    prefix = own.select("rep", "root", "n", "shared", alone.alias("alone"), probe.alias("probe"), index.alias("index"))
    prefix = scratch.spill(prefix.select("rep", "root", "n", "index", "alone", F.posexplode(front).alias("at", "s")).select(
        "rep", "root", "n", "index", (F.col("alone") + F.col("at")).alias("place"), F.col("s.token").alias("token")
    ))
    short = prefix.where("place < index").select("token", *(F.col(c).alias(f"{c}_a") for c in ("rep", "root", "n", "place")))
    long = prefix.select("token", *(F.col(c).alias(f"{c}_b") for c in ("rep", "root", "n", "place")))
    needed = f"ceil({percent} * (n_a + n_b) / {100 + percent})"
    passes = (
        f"root_a != root_b and (n_a < n_b or n_a = n_b and rep_a < rep_b) and 100 * n_a >= {percent} * n_b "
        f"and 1 + least(n_a - place_a - 1, n_b - place_b - 1) >= {needed}"
    )
    pairs = short.join(long, "token").where(passes)
    return pairs.select(F.least("rep_a", "rep_b").alias("a"), F.greatest("rep_a", "rep_b").alias("b")).distinct()


def drop_near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one document
    of each group, the one with the smallest ``doc_id``."""
    judged = near_duplicates(docs, shingle, percent)
    gone = judged.where("not kept").select("doc_id").distinct()
    left = docs.alias("d").join(gone.alias("g"), F.col("d.doc_id").cast("long") == F.col("g.doc_id"), "left_anti")
    repeated = docs.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1")
    if repeated.isEmpty():
        return left
    # rows without an id are documents of their own, also where their texts agree
    return left.where("doc_id is not null").dropDuplicates(["doc_id", "text"]).union(left.where("doc_id is null"))

"""Benchmark decontamination by the q-gram lemma.

A benchmark item is searched by its windows of ``WINDOW`` characters, one at
every place (an item shorter than a window is one window).  Two texts of
which one has ``n`` characters and that are within ``k`` edits share at least
``n - q + 1 - k * q`` q-grams, all within ``k`` diagonals of each other.  So
every document is slid over its q-grams; shared q-grams are gathered by item
and diagonal band (bands overlap by half, so that a run within ``k``
diagonals lies whole in one of them), the windows whose stretch of the item
reaches the lemma's bound are kept, and each is verified by a banded alignment
of the whole window.  A quote shorter than a window from a longer item is no
leak.

Texts are compared lower-cased with runs of white space as one space.

The benchmark's q-gram index is a map-side table, so it is bounded:
``max_index_chars`` characters at most; a larger benchmark is searched in
several parts, each within the bound, one after the other over the documents.

Defined cases: a null text holds nothing; items of fewer than ``min_chars``
characters after normalisation (or null ones) are not searched for, being
too short to tell a leak; a null ``item_id`` is reported as null; repeated
items and rows are reported alike; columns besides those named are ignored
by :func:`find_leaks` and carried through by :func:`drop_leaks`.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwise.llm.common import map_batches, pieces, tidy

Q = 8
WINDOW = 96
MIN_CHARS = 40
EDIT_SHARE = 0.1
MAX_INDEX_CHARS = 32_000_000
PIECE_CHARS = 2_000_000
ALIGN_WINDOWS = 1024
_BASE = np.uint32(0x9E3779B1)
_FILTER_BITS = 22

LEAK_SCHEMA = "doc_id long, contaminated boolean, n_items long, item_ids string, n_regions long, best_distance long"


def normalise(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)


def _grams(codes: np.ndarray) -> np.ndarray:
    """Hashes of all windows of Q = 8 characters (doubling)."""
    h, p = (codes + np.uint32(1)) * np.uint32(0xB86659FD), _BASE
    with np.errstate(over="ignore"):
        for width in (1, 2, 4):
            h = h[: max(0, len(h) - width)] * p + h[width:]
            p = p * p
    return h


def _cells(h: np.ndarray) -> np.ndarray:
    return h >> np.uint32(32 - _FILTER_BITS)


@dataclass
class Index:
    """Q-gram postings of some benchmark items."""

    items: list
    texts: list[np.ndarray]  # characters of each item
    width: np.ndarray  # characters of an item's windows
    edits: np.ndarray  # edit budget of a window
    bound: np.ndarray  # shared q-grams the lemma asks of a window
    keys: np.ndarray  # distinct q-grams, sorted
    first: np.ndarray  # postings of key i: first[i]:first[i+1]
    owner: np.ndarray
    place: np.ndarray
    filter: np.ndarray


def build_index(rows: list[tuple]) -> Index | None:
    items, texts = [], []
    for item, text in rows:
        text = normalise(text)
        if len(text) < MIN_CHARS:
            continue
        items.append(item)
        texts.append(_codes(text))
    if not texts:
        return None
    width = np.minimum([len(t) for t in texts], WINDOW)
    edits = (width * EDIT_SHARE).astype(np.int64)
    grams = [_grams(t) for t in texts]
    h = np.concatenate(grams)
    owner = np.repeat(np.arange(len(texts)), [len(g) for g in grams])
    place = np.concatenate([np.arange(len(g)) for g in grams])
    order = np.argsort(h, kind="stable")
    keys, first = np.unique(h[order], return_index=True)
    cells = np.zeros(1 << _FILTER_BITS, bool)
    cells[_cells(keys)] = True
    return Index(items, texts, width, edits, np.maximum(1, width - Q + 1 - Q * edits), keys, np.append(first, len(h)), owner[order], place[order], cells)


def align(pattern: np.ndarray, text: np.ndarray, lo: int, edits: int) -> int:
    """Edit distance of the whole pattern to some stretch of the text that
    begins on a diagonal of ``lo .. lo + width``, computed on the band of
    diagonals ``lo - edits .. lo + width + edits``; ``edits + 1`` if above."""
    return int(align_windows(pattern, np.zeros(1, np.int64), len(pattern), text, lo, edits)[0])


def align_windows(item: np.ndarray, starts: np.ndarray, width: int, text: np.ndarray, lo: int, edits: int) -> np.ndarray:
    """:func:`align` of the item's windows at ``starts``, ``lo`` being a
    diagonal of the whole item."""
    far = edits + 1
    j = np.arange(2 * (edits + 1) + 2 * edits + 1, dtype=np.int32)
    out = np.full(len(starts), far, np.int64)
    row = np.arange(len(starts))
    diag = lo - edits + starts[:, None] + j
    # row i, diagonal d: cost of pattern[:i] against a stretch ending before text[i + d]
    cost = np.where((diag >= 0) & (diag <= len(text)), 0, far).astype(np.int32)
    for i in range(width):
        at = diag + i
        inside = (at >= 0) & (at < len(text))
        same = text[np.clip(at, 0, len(text) - 1)] == item[starts + i][:, None]
        step = np.where(inside, cost + ~same, far)
        step[:, :-1] = np.minimum(step[:, :-1], cost[:, 1:] + 1)  # a pattern character left out
        step = np.minimum.accumulate(step - j, axis=1) + j  # text characters left out
        cost = np.minimum(step, far)
        if i % 8 == 7:  # windows that are out already
            alive = cost.min(axis=1) < far
            if not alive.all():
                row, starts, diag, cost = row[alive], starts[alive], diag[alive], cost[alive]
                if not len(row):
                    return out
    out[row] = cost.min(axis=1)
    return out


def _verbatim(item: np.ndarray, starts: np.ndarray, width: int, text: np.ndarray, lo: int, edits: int) -> np.ndarray:
    """Which windows the text holds unchanged on a diagonal of the band."""
    first, last = int(starts[0]), int(starts[-1]) + width
    at = lo + np.arange(2 * (edits + 1) + 1)[:, None] + np.arange(first, last)
    same = (at >= 0) & (at < len(text)) & (text[np.clip(at, 0, len(text) - 1)] == item[first:last])
    run = np.concatenate((np.zeros((len(at), 1), np.int64), np.cumsum(same, axis=1)), axis=1)
    return ((run[:, starts - first + width] - run[:, starts - first]) == width).any(axis=0)


def _search(texts: list, index: Index) -> list[dict]:
    """For each text, the items found: item number -> window -> distance."""
    found: list[dict] = [{} for _ in texts]
    codes = [_codes(normalise(t)) for t in texts]
    gap = np.zeros(1, np.uint32)
    joined = np.concatenate([x for c in codes for x in (c, gap)]) if codes else gap
    starts = np.cumsum([0, *(len(c) + 1 for c in codes)])
    h = _grams(joined)
    pos = np.flatnonzero(index.filter[_cells(h)])
    if not len(pos):
        return found
    at = np.searchsorted(index.keys, h[pos])
    hit = index.keys[np.minimum(at, len(index.keys) - 1)] == h[pos]
    pos, at = pos[hit], at[hit]
    # any window's region spans so many characters and needs so many hits
    least, span = int(index.bound.min()), WINDOW + 4 * int(index.edits.max() + 1)
    if len(pos) < least:
        return found
    near = np.flatnonzero(pos[least - 1 :] - pos[: len(pos) - least + 1] <= span)
    mark = np.zeros(len(pos) + 1, np.int64)
    mark[near] += 1
    mark[near + least] -= 1
    alive = np.cumsum(mark)[:-1] > 0
    pos, at = pos[alive], at[alive]
    if not len(pos):
        return found
    doc = np.searchsorted(starts, pos, side="right") - 1
    for lo, hi in _shares(index.first[at + 1] - index.first[at], doc):
        _verify(pos[lo:hi], at[lo:hi], doc[lo:hi], starts, codes, index, found)
    return found


def _shares(sizes: np.ndarray, doc: np.ndarray, limit: int = 1_000_000):
    """Runs of whole documents with at most ``limit`` postings (or one
    document)."""
    cuts = np.append(np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1]))), len(doc))
    total = np.concatenate(([0], np.cumsum(sizes)))[cuts]
    i = 0
    while i < len(cuts) - 1:
        j = max(i + 1, int(np.searchsorted(total, total[i] + limit, side="right")) - 1)
        yield int(cuts[i]), int(cuts[j])
        i = j


def _verify(pos, at, doc, starts, codes, index: Index, found) -> None:
    n = index.first[at + 1] - index.first[at]
    hit = np.repeat(np.arange(len(pos)), n)
    posting = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(index.first[at], n)
    own = index.owner[posting]
    # an item with fewer hits in the whole document than its bound is out
    wide = len(index.texts)
    pair = (doc[hit] - doc[0]) * wide + own
    if (doc[-1] - doc[0] + 1) * wide <= 1 << 24:
        enough = np.bincount(pair)[pair] >= index.bound[own]
    else:
        _, back, total = np.unique(pair, return_inverse=True, return_counts=True)
        enough = total[back] >= index.bound[own]
    if not enough.any():
        return
    hit, own, place = hit[enough], own[enough], index.place[posting[enough]]
    diagonal = pos[hit] - starts[doc[hit]] - place
    band = diagonal // (index.edits[own] + 1)
    offset = int(band.min()) - 1
    bands = int(band.max()) - offset + 1
    group = (doc[hit] * wide + own) * bands + (band - offset)
    both = np.concatenate((group, group - 1))  # a diagonal lies in two bands
    place = np.concatenate((place, place))
    order = np.lexsort((place, both))
    both, place = both[order], place[order]
    distinct = np.concatenate(([True], (both[1:] != both[:-1]) | (place[1:] != place[:-1])))
    both, place = both[distinct], place[distinct]
    # runs of as many places as the bound asks, within the q-grams of a window
    own = both // bands % wide
    last = np.arange(len(both)) + index.bound[own] - 1
    run = np.flatnonzero(last < len(both))
    last = last[run]
    run_fits = (both[last] == both[run]) & (place[last] - place[run] <= index.width[own[run]] - Q)
    run, last = run[run_fits], last[run_fits]
    cuts = np.flatnonzero(np.concatenate(([True], both[run][1:] != both[run][:-1]))) if len(run) else run
    for lo_run, hi_run in zip(cuts.tolist(), [*cuts.tolist()[1:], len(run)], strict=False):
        k = int(both[run[lo_run]])
        d, item = k // bands // wide, k // bands % wide
        text, edits, width = index.texts[item], int(index.edits[item]), int(index.width[item])
        # every window that holds one of the runs
        mark = np.zeros(len(text) - width + 2, np.int64)
        np.add.at(mark, np.clip(place[last[lo_run:hi_run]] + Q - width, 0, len(mark) - 2), 1)
        np.add.at(mark, np.minimum(place[run[lo_run:hi_run]], len(mark) - 2) + 1, -1)
        windows = np.flatnonzero(np.cumsum(mark) > 0)
        best = found[d].setdefault(item, {})
        windows = windows[[best.get(w) != 0 for w in windows.tolist()]]
        for part in range(0, len(windows), ALIGN_WINDOWS):
            some = windows[part : part + ALIGN_WINDOWS]
            _align_band(some, text, width, codes[d], (k % bands + offset) * (edits + 1), edits, best)


def _align_band(windows, text, width, doc, lo, edits, best: dict) -> None:
    """Puts the distances of the windows found on one band into ``best``."""
    whole = _verbatim(text, windows, width, doc, lo, edits)
    best.update(dict.fromkeys(windows[whole].tolist(), 0))
    windows = windows[~whole]
    if len(windows):
        dist = align_windows(text, windows, width, doc, lo, edits)
        for w, x in zip(windows.tolist(), dist.tolist(), strict=True):
            if x <= edits:
                best[w] = min(x, best.get(w, x))


def search(texts: list, index: Index | None) -> list[list[tuple]]:
    """``(item, smallest distance, number of windows found)`` of each text."""
    if index is None:
        return [[] for _ in texts]
    out = []
    for found in _search(texts, index):
        out.append([(index.items[i], min(w.values()), len(w)) for i, w in sorted(found.items()) if w])
    return out


def _parts(benchmark: DataFrame, max_index_chars: int) -> list[list[tuple]]:
    """The benchmark's rows in parts of at most ``max_index_chars``
    characters each (one item at least), fetched one part at a time."""
    items = benchmark.select("item_id", F.col("text").cast("string").alias("text")).where("text is not null")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-2 * total // max_index_chars)) if total > max_index_chars else 1
    place = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    return [sorted(((r["item_id"], r["text"]) for r in items.where(place == i).collect()), key=str) for i in range(n)]


def find_leaks(docs: DataFrame, benchmark: DataFrame, max_index_chars: int = MAX_INDEX_CHARS) -> DataFrame:
    """One row per document: whether it holds a benchmark passage, which
    items (comma-joined, ascending), in how many windows, at what distance."""
    cur = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn(
        "hits", F.expr("cast(array() as array<struct<item: string, dist: long, n: long>>)")
    )
    kind = pa.list_(pa.struct([("item", pa.string()), ("dist", pa.int64()), ("n", pa.int64())]))
    for rows in _parts(benchmark, max_index_chars):

        def run(batches, rows=rows):
            index = build_index(rows)
            for whole in batches:
                for b in pieces(whole, PIECE_CHARS, "text"):
                    old = b.column("hits").to_pylist()
                    new = [
                        o + [{"item": None if i is None else str(i), "dist": d, "n": n} for i, d, n in f]
                        for o, f in zip(old, search(b.column("text").to_pylist(), index), strict=True)
                    ]
                    yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text"), pa.array(new, kind)], ["doc_id", "text", "hits"])
            tidy()

        cur = map_batches(cur, run, cur.schema)
    ids = F.array_sort(F.array_distinct(F.transform("hits", lambda h: F.coalesce(h["item"], F.lit("null")))), lambda a, b: F.when(
        F.length(a) != F.length(b), F.length(a) - F.length(b)).when(a < b, F.lit(-1)).when(a > b, F.lit(1)).otherwise(F.lit(0)))
    return cur.select(
        "doc_id",
        (F.size("hits") > 0).alias("contaminated"),
        F.size(ids).cast("long").alias("n_items"),
        F.concat_ws(",", ids).alias("item_ids"),
        F.aggregate("hits", F.lit(0).cast("long"), lambda s, h: s + h["n"]).alias("n_regions"),
        F.array_min(F.transform("hits", lambda h: h["dist"])).alias("best_distance"),
    )


def drop_leaks(docs: DataFrame, benchmark: DataFrame, max_index_chars: int = MAX_INDEX_CHARS) -> DataFrame:
    """The rows of ``docs`` without a benchmark passage, all columns kept."""
    for rows in _parts(benchmark, max_index_chars):

        def run(batches, rows=rows):
            index = build_index(rows)
            for whole in batches:
                for b in pieces(whole, PIECE_CHARS, "text"):
                    hits = search(b.column("text").to_pylist(), index)
                    yield b.filter(pa.array([not h for h in hits], pa.bool_()))
            tidy()

        docs = map_batches(docs, run, docs.schema)
    return docs

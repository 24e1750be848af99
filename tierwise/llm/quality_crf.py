"""Quality rules by line sequence labelling.

Every line with a word becomes one position of a sequence; a linear-chain
conditional random field over a few surface features labels it content or
boilerplate (Viterbi), and the share of a document's words on content lines
decides whether the document stays.  Base counts (short documents, documents
made of repeated three-word windows) reject first.

The field is trained on a bounded sample of labelled documents
(``max_docs``, the smallest hashes of ``doc_id``): the lines of a document
labelled good are content, those of one labelled bad are boilerplate.

Defined cases: a null text has no words (so it fails the base rules); a
sample that lacks one of the two classes gives the zero model, under which
every line is content; repeated rows are judged alike, one result each;
columns other than ``doc_id`` and ``text`` are ignored by :func:`score` and
carried through by :func:`keep`.  Null ``doc_id``s are judged like any other.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwise.llm.common import map_batches, pieces, tidy
from tierwise.llm.crf import Adam, Packing, forward_backward, viterbi

SPACES = " \t\n\r\v\f"
SYMBOLS = "#*$%&|<>"
BOILERPLATE, CONTENT = 0, 1
_UPPER = bytes(range(65, 91))
_DIGIT = b"0123456789"
_SYMBOL = SYMBOLS.encode()
#: upper bounds of the bins of each line feature
SYMBOL_BINS = (0.0, 0.1, 0.3, 1.0)
UPPER_BINS = (0.1, 0.3)
DIGIT_BINS = (0.05, 0.2)
LENGTH_BINS = (2, 5, 15)
VARIETY_BINS = (0.2, 0.5)
_GROUPS = (len(SYMBOL_BINS) + 1, len(UPPER_BINS) + 1, len(DIGIT_BINS) + 1, len(LENGTH_BINS) + 1, len(VARIETY_BINS) + 1, 2, 2)
_BASE = np.concatenate(([0], np.cumsum(_GROUPS)[:-1]))
N_FEATURES = int(sum(_GROUPS))

SCORE_SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, content_share double"
)


@dataclass
class LineField:
    """Weights of the trained field and the decision threshold."""

    emit: np.ndarray = field(default_factory=lambda: np.zeros((N_FEATURES, 2)))
    trans: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    start: np.ndarray = field(default_factory=lambda: np.zeros(2))
    min_content: float = 0.5


def _bin(value: float, bounds) -> int:
    for i, b in enumerate(bounds):
        if value <= b:
            return i
    return len(bounds)


def read_lines(text: str):
    """Words of each line that has one, the line features, and how many lines
    repeat an earlier one."""
    counts, rows, seen, dups = [], [], set(), 0
    for line in text.encode("utf-8", "replace").split(b"\n"):
        words = line.split()
        n = len(words)
        if not n:
            continue
        again = line in seen
        dups += again
        seen.add(line)
        size = len(line)
        counts.append(n)
        rows.append((
            _bin((size - len(line.translate(None, _SYMBOL))) / n, SYMBOL_BINS),
            _bin((size - len(line.translate(None, _UPPER))) / size, UPPER_BINS),
            _bin((size - len(line.translate(None, _DIGIT))) / size, DIGIT_BINS),
            _bin(n, LENGTH_BINS),
            _bin(len(set(words)) / n, VARIETY_BINS),
            int(again),
            int(words[-1][-1:] in b".!?"),
        ))
    return counts, rows, dups


def repeated_words(words: list) -> int:
    """Words inside three-word windows that occur twice or more."""
    n = len(words)
    if n < 4:
        return 0
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    often = Counter(windows)
    total, end = 0, 0
    for i, w in enumerate(windows):
        if often[w] > 1:
            total += i + 3 - max(end, i)
            end = i + 3
    return total


def _scores(rows, model: LineField) -> np.ndarray:
    if not rows:
        return np.zeros((0, 2))
    return model.emit[np.asarray(rows, dtype=np.int64) + _BASE].sum(axis=1)


def judge(texts, model: LineField) -> list[tuple]:
    """The seven counts and verdicts of each text."""
    out, lengths, rows, shares = [], [], [], []
    for text in texts:
        text = text or ""
        counts, feats, dups = read_lines(text)
        words = text.encode("utf-8", "replace").split()
        out.append((
            len(words),
            len(text) - sum(map(text.count, SPACES)),
            sum(map(text.count, SYMBOLS)),
            dups,
            repeated_words(words),
        ))
        lengths.append(len(counts))
        rows += feats
        shares.append(counts)
    labels = viterbi(Packing(lengths), _scores(rows, model), model.trans, model.start) if rows else np.zeros(0)
    at, done = 0, []
    for base, counts in zip(out, shares, strict=True):
        own = labels[at : at + len(counts)]
        at += len(counts)
        n = base[0]
        share = float(np.dot(own, counts)) / n if n else 0.0
        failed = n < 50 or 100 * base[4] > 50 * n
        done.append((*base, failed, not failed and share >= model.min_content, share))
    return done


PIECE = 4_000_000


def score(docs: DataFrame, model: LineField) -> DataFrame:
    """One row per document: base counts, verdicts and the content share."""

    def run(batches):
        for whole in batches:
            for b in pieces(whole, PIECE, "text"):
                rows = judge(b.column("text").to_pylist(), model)
                cols = [list(c) for c in zip(*rows, strict=True)] if rows else [[]] * 8
                kinds = [pa.int64()] * 5 + [pa.bool_(), pa.bool_(), pa.float64()]
                names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "content_share"]
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], ["doc_id", *names]
                )
        tidy()

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_batches(read, run, SCORE_SCHEMA)


def keep(docs: DataFrame, model: LineField) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns."""

    def run(batches):
        for whole in batches:
            for b in pieces(whole, PIECE, "text"):
                rows = judge(b.column("text").to_pylist(), model)
                yield b.filter(pa.array([r[6] for r in rows], pa.bool_()))
        tidy()

    return map_batches(docs, run, docs.schema)


def train(docs: DataFrame, labels: DataFrame, max_docs: int = 2000, steps: int = 80, min_content: float = 0.5) -> LineField:
    """Fits the field on at most ``max_docs`` labelled documents, chosen by
    hash.  Only that bounded sample reaches the driver."""
    picked = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("quality").cast("int").alias("good"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_docs)
        .collect()
    )
    good = {r["doc_id"]: r["good"] for r in picked}
    model = LineField(min_content=min_content)
    if len(set(good.values())) < 2:
        return model
    sample = docs.where(F.col("doc_id").isin(list(good))).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = map_batches(sample.dropDuplicates(["doc_id"]), _line_rows, "doc_id long, rows binary").collect()
    lengths, rows, gold = [], [], []
    for r in sorted(texts, key=lambda r: r["doc_id"]):
        feats = np.frombuffer(r["rows"], np.uint8).reshape(-1, len(_GROUPS))
        if len(feats):
            lengths.append(len(feats))
            rows.append(feats)
            gold.append(np.full(len(feats), good[r["doc_id"]]))
    if not rows or len(set(map(int, np.concatenate(gold)))) < 2:
        return model
    x, y, pack = np.concatenate(rows).astype(np.int64) + _BASE, np.concatenate(gold), Packing(lengths)
    first = np.cumsum([0, *lengths[:-1]])
    inner = np.ones(len(y), bool)
    inner[first] = False
    seen_pairs = np.zeros((2, 2))
    np.add.at(seen_pairs, (y[np.flatnonzero(inner) - 1], y[inner]), 1)
    seen_start = np.bincount(y[first], minlength=2).astype(float)
    one_hot = np.eye(2)[y]
    opt = Adam([model.emit, model.trans, model.start], 0.15)
    for _ in range(steps):
        gamma, _, expected = forward_backward(pack, model.emit[x].sum(axis=1), model.trans, model.start, pairs=True)
        gap, g_emit = one_hot - gamma, np.zeros_like(model.emit)
        for j in range(x.shape[1]):
            np.add.at(g_emit, x[:, j], gap)
        n = len(y)
        opt.step([
            g_emit / n - 1e-4 * model.emit,
            (seen_pairs - expected) / n - 1e-2 * model.trans,
            (seen_start - gamma[first].sum(axis=0)) / len(lengths) - 1e-2 * model.start,
        ])
    return model


def _line_rows(batches):
    """Line features of the training texts, one byte each."""
    for b in batches:
        feats = [np.asarray(read_lines(t or "")[1], np.uint8).tobytes() for t in b.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(feats, pa.binary())], ["doc_id", "rows"])

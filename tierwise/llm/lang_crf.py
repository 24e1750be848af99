"""Language identification by a linear-chain conditional random field.

The words of a text are the positions of a sequence and the languages its
labels, so code-switched text gets a label per word.  A word's score sums the
weights of its character n-grams (with word boundaries, so that prefixes and
suffixes are features of their own) and of the whole word (a lexicon hashed
into the same weight table); learned transitions tie neighbouring words, and
forward-backward gives each word's posterior.  A document's language is the
label with the largest expected number of words.

The field is trained here, on a bounded sample of documents with a language
(``per_language`` documents of each, whole texts, the smallest hashes; every
language that occurs is learned, so sample and model grow with their number):
gradient ascent on the likelihood of word sequences, among them sequences
spliced from documents of different languages, from which the transitions
learn how code-switching looks.

Defined cases: a null text or one without a letter is ``und`` with score 0;
so is every text if nothing could be learned; a null ``doc_id`` counts as the
empty string for the held-out rule; columns besides ``doc_id``, ``text`` and
(for training) ``lang`` are ignored; repeated rows get the same answer.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwise.llm.common import map_batches, pieces, tidy
from tierwise.llm.crf import Adam, Packing, forward_backward

SLOT_BITS = 16
_SLOTS = 1 << SLOT_BITS
PIECE_CHARS = 3_000_000
#: words x languages of a training batch (a sequence has 120 words at most)
TRAIN_CELLS = 8_000_000
LANG_SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"


@dataclass
class LanguageField:
    langs: list[str]
    emit: np.ndarray  # slots x languages
    trans: np.ndarray
    start: np.ndarray


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the id's text leaves the remainder 0 modulo 5."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


_LETTER = None


def _letters() -> np.ndarray:
    """Which code points are letters."""
    global _LETTER
    if _LETTER is None:
        _LETTER = np.array([chr(i).isalpha() for i in range(0x110000)])
    return _LETTER


def _slot(h: np.ndarray) -> np.ndarray:
    return ((h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - SLOT_BITS)


def features(texts: list[str]):
    """Words per text, first letter of each word, and the feature slots of
    each letter (an n-gram of two and one of three ending there, where the
    character before a word is a boundary), plus the slots that belong to
    whole words (the word itself and its closing n-gram)."""
    codes = np.frombuffer("\n".join([*texts, ""]).lower().encode("utf-32-le", "replace"), np.uint32)
    ends = np.flatnonzero(np.frombuffer("\n".join([*(t.replace("\n", " ") for t in texts), ""]).lower().encode("utf-32-le", "replace"), np.uint32) == 10)
    letter = _letters()[np.minimum(codes, 0x10FFFF)]
    x = np.where(letter, codes, 0).astype(np.uint32)
    p1 = np.concatenate((x[:1] * 0, x[:-1]))
    p2 = np.concatenate((p1[:1] * 0, p1[:-1]))
    p2[p1 == 0] = 0
    two = p1 * np.uint32(0x01000193) ^ (x * np.uint32(0x9E3779B1))
    three = two * np.uint32(31) ^ (p2 * np.uint32(0x85EBCA6B)) ^ np.uint32(0x5BD1E995)
    begin = np.flatnonzero(letter & ~np.concatenate(([False], letter[:-1])))
    stop = np.flatnonzero(letter & ~np.append(letter[1:], False))
    at = np.flatnonzero(letter)
    first = np.searchsorted(at, begin)
    slots2, slots3 = _slot(two[at]), _slot(three[at])
    if len(begin):
        place = (np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))).astype(np.uint32)
        whole = np.add.reduceat((x[at] + np.uint32(7)) * (place * np.uint32(0x9E3779B1) + np.uint32(0x7FEB352D) ^ (place << np.uint32(13))), first, dtype=np.uint32)
        tail = (x[stop] * np.uint32(0xCC9E2D51)) ^ (p1[stop] * np.uint32(0x1B873593)) ^ (p2[stop] * np.uint32(0x297A2D39)) ^ np.uint32(0x3C6EF372)
        own = np.stack([_slot(whole), _slot(tail)], axis=1)
    else:
        own = np.zeros((0, 2), np.uint32)
    counts = np.diff(np.concatenate(([0], np.searchsorted(begin, ends))))
    return counts, first, slots2, slots3, own


def emissions(feats, emit: np.ndarray) -> np.ndarray:
    _, first, s2, s3, own = feats
    if not len(first):
        return np.zeros((0, emit.shape[1]), emit.dtype)
    return np.add.reduceat(emit[s2] + emit[s3], first, axis=0) + emit[own[:, 0]] + emit[own[:, 1]]


def identify(texts: list, model: LanguageField) -> list[tuple]:
    """``(language, score)`` of each text."""
    if not model.langs:
        return [("und", 0.0)] * len(texts)
    feats = features([t or "" for t in texts])
    counts = feats[0]
    post = forward_backward(Packing(counts), emissions(feats, model.emit), model.trans, model.start)
    out, lo = [], 0
    sums = np.concatenate((np.zeros((1, post.shape[1])), np.cumsum(post, axis=0, dtype=np.float64)))
    for n in counts.tolist():
        if not n:
            out.append(("und", 0.0))
            continue
        share = (sums[lo + n] - sums[lo]) / n
        lo += n
        best = int(share.argmax())
        out.append((model.langs[best], float(min(1.0, max(0.0, share[best])))))
    return out


def predict(docs: DataFrame, model: LanguageField) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every document."""

    def run(batches):
        for whole in batches:
            for b in pieces(whole, PIECE_CHARS * 8 // max(8, len(model.langs)), "text"):
                rows = identify(b.column("text").to_pylist(), model)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), b.column("held_out"), pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.float64())],
                    ["doc_id", "held_out", "lang_pred", "score"],
                )
        tidy()

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("text"))
    return map_batches(read, run, LANG_SCHEMA)


def train(docs: DataFrame, per_language: int = 150, epochs: int = 12, seed: int = 5) -> LanguageField:
    """Fits the field on a bounded sample of the documents that aren't held
    out: about ``per_language`` of each language, at most twice as many."""
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")
    )
    sizes = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(sizes)
    if not langs:
        return LanguageField([], np.zeros((_SLOTS, 0), np.float32), np.zeros((0, 0)), np.zeros(0))
    place = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 40))
    share = [(lang, int(min(1.0, per_language / n) * (1 << 40))) for lang, n in sizes.items()]
    shares = docs.sparkSession.createDataFrame(share, "lang string, share long")
    rows = usable.join(F.broadcast(shares), "lang").where(place < F.col("share")).orderBy(place, "doc_id").limit(2 * per_language * len(langs)).collect()
    rows.sort(key=lambda r: (r["doc_id"], r["text"]))
    rng = np.random.default_rng(seed)
    texts = [r["text"] for r in rows]
    label = [langs.index(r["lang"]) for r in rows]
    feats = features(texts)
    counts, first, s2, s3, own = feats
    k = len(langs)
    bounds = np.concatenate(([0], np.cumsum(counts)))
    # sequences: stretches of single documents, and splices of two or three
    stretches = [(d, lo, min(lo + 40, hi)) for d in range(len(texts)) for lo, hi in [(bounds[d], bounds[d + 1])] for lo in range(lo, hi, 40)]
    rng.shuffle(stretches)
    spliced = len(stretches) // 4
    sequences = [[s] for s in stretches[spliced:]]
    i = 0
    while i < spliced:
        n = int(rng.integers(2, 4))
        sequences.append(stretches[i : min(i + n, spliced)])
        i += n
    rng.shuffle(sequences)
    emit = np.zeros((_SLOTS, k), np.float32)
    trans, start = np.eye(k) * 2.0, np.zeros(k)
    opt = Adam([emit, trans, start], 0.05)
    lens = np.diff(np.append(first, len(s2)))
    batch = max(1, min(len(sequences) // 8 + 1, TRAIN_CELLS // (120 * k)))
    for _ in range(epochs):
        for at in range(0, len(sequences), batch):
            seqs = sequences[at : at + batch]
            words = np.concatenate([np.arange(lo, hi) for s in seqs for _, lo, hi in s])
            gold = np.concatenate([np.full(hi - lo, label[d]) for s in seqs for d, lo, hi in s])
            n_of = [sum(hi - lo for _, lo, hi in s) for s in seqs]
            letters = np.repeat(first[words], lens[words]) + _ranges(lens[words])
            at_word = np.concatenate(([0], np.cumsum(lens[words])[:-1]))
            part = (np.array(n_of), at_word, s2[letters], s3[letters], own[words])
            pack = Packing(part[0])
            post, _, expected = forward_backward(pack, emissions(part, emit).astype(np.float64), trans, start, pairs=True)
            gap = (np.eye(k)[gold] - post).astype(np.float32)
            grad = np.zeros_like(emit)
            each = np.repeat(gap, lens[words], axis=0)
            for c in range(k):
                for idx, val in ((part[2], each[:, c]), (part[3], each[:, c]), (part[4][:, 0], gap[:, c]), (part[4][:, 1], gap[:, c])):
                    grad[:, c] += np.bincount(idx, val, _SLOTS).astype(np.float32)
            heads = np.cumsum([0, *n_of[:-1]])
            inner = np.ones(len(gold), bool)
            inner[heads] = False
            seen = np.zeros((k, k))
            np.add.at(seen, (gold[np.flatnonzero(inner) - 1], gold[inner]), 1)
            n = len(gold)
            opt.step([grad / n - 1e-6 * emit, (seen - expected) / n - 1e-4 * trans, (np.bincount(gold[heads], minlength=k) - post[heads].sum(axis=0)) / len(n_of) - 1e-3 * start])
    return LanguageField(langs, emit, trans.astype(np.float32), start.astype(np.float32))


def _ranges(lens: np.ndarray) -> np.ndarray:
    """0..n-1 for each length n, joined."""
    total = int(lens.sum())
    return np.arange(total) - np.repeat(np.cumsum(lens) - lens, lens)

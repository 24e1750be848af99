"""Blocked search against scoring every document for every item."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from docs_fixture import empty, frame, rows

from tierwise.llm import block_search as S
from tierwise.llm.common import table

SF = "/root/testdata/sf0.001"
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, items, k=50):
    bags = [(d, Counter(TERM.findall((t or "").translate(LOWER)))) for d, t in docs]
    bags = [(d, b, b.total()) for d, b in bags if b]
    total, df = sum(n for *_, n in bags), Counter(t for _, b, _ in bags for t in b)
    asked: dict = {}
    for i, t in items:
        asked.setdefault(i, set()).update(TERM.findall((t or "").translate(LOWER)))
    out = []
    for i, want in asked.items():
        ranked = []
        for d, b, n in bags:
            m = 100 - 50 + 50 * n * len(bags) // total
            score = sum(math.floor(1000 * math.log((2 * len(bags) + 2) / (2 * df[t] + 1))) * (1_000_000_000 * b[t] // (1000 * b[t] + 20 * m)) for t in want if t in b)
            if score > 0:
                ranked.append((-score, d is not None, d or 0, d))
        out += [(i, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(ranked, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def items_frame(spark, data):
    return spark.createDataFrame([(*r, "x", "y") for r in data], "item_id long, text string, score string, row string")


def skewed(n=600):
    """Zipf words, a third of all documents alike, many ties."""
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    data = [(i, " ".join(rng.choices(vocab, weights, k=rng.randint(1, 60))), None, None, 0) for i in range(n)]
    return data + [(n + i, "w1 w2, W3 w250", None, None, 0) for i in range(n // 2)]


@pytest.mark.parametrize(("block", "shard", "max_terms"), [(4, 500, 500_000), (64, 1 << 20, 20)])
def test_skewed_documents(spark, block, shard, max_terms):
    data, rng = skewed(), random.Random(6)
    items = [(i, " ".join(f"w{int(rng.random() ** 2 * 300)}" for _ in range(rng.randint(1, 12)))) for i in range(12)]
    items += [(3, "w250 W1"), (None, "w7"), (None, "w250"), (90, None), (91, ""), (92, "nothing here"), (3, "w250 W1")]
    df = S.search(frame(spark, data), items_frame(spark, items), block=block, pivots=5, shard_postings=shard, max_terms=max_terms)
    assert got(df) == brute([r[:2] for r in data], items)


def test_defined_cases(spark):
    data = [r for r in rows() if r[0] != 103]
    items = [(0, data[0][1]), (1, "É日本 a1_b2"), (2, data[1][1].upper())]
    data += [(500, "é日本 É日本\x00a1-b2"), (501, "a1_b2")]
    full = [(*r, *([None] * (5 - len(r)))) for r in data]
    assert got(S.search(frame(spark, full), items_frame(spark, items))) == brute([r[:2] for r in full], items)
    assert S.search(empty(spark), items_frame(spark, items)).count() == 0
    assert S.search(frame(spark, full), items_frame(spark, [])).count() == 0


def test_blocks_are_skipped_and_nothing_is_lost():
    rng = np.random.default_rng(1)
    groups = [np.sort(rng.choice(200, 30, replace=False)) for _ in range(20)]
    lists = [np.sort(rng.choice(groups[i % 20], 12, replace=False)) for i in range(4000)]
    vecs = S.Vectors(np.arange(0, 12 * 4000 + 1, 12), np.concatenate(lists), rng.integers(1, 10**6, 12 * 4000))
    items = [groups[0][:10], groups[7][5:20]]
    asked = {}
    for c in range(200):
        asked[c] = [q for q, cols in enumerate(items) if c in cols]
    n = 4000
    shard = S.Shard(vecs, [np.arange(n), np.zeros(n, bool), np.arange(n)], asked, items, 200, 32)
    for q, cols in enumerate(items):
        best = S.Best(10)
        skipped = shard.search(q, cols, best)
        scores = np.array([vecs.vals[12 * i : 12 * i + 12][np.isin(lists[i], cols)].sum() for i in range(n)])
        assert best.rows[0].tolist() == np.sort(scores)[::-1][:10].tolist() and skipped > 0


def test_whole_tables(spark):
    from tierwise.llm.registry import QUERIES

    docs = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    items = [tuple(r) for r in table(spark, SF, "benchmark").select("item_id", "text").collect()]
    assert got(QUERIES["op12_block_search"](spark, SF)) == brute(docs, items)



"""The prefix trie against a plain one."""

import hashlib
import random
import zlib

import pytest

from tierwise.llm import prefix_trie as P
from tierwise.llm.common import table

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, key string, depth string, conv string, shard string"


def frame(spark, data):
    return spark.createDataFrame([(*r, "k", "d", "c", "s") for r in data], SCHEMA)


def brute(data):
    convs: dict = {}
    for c, turn, role, text in data:
        if c is not None:
            role, text = role or "", text or ""
            convs.setdefault(c, []).append((turn is not None, turn or 0, role, hashlib.sha256(text.encode()).hexdigest(), text))
    turns = {c: [(r[2], r[4]) for r in sorted(rows)] for c, rows in convs.items()}
    again = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        again[c] = turns.get(c - c % 5, [])[:h] + own[h:]
    nodes: dict = {}
    for c, ts in again.items():
        for d in range(len(ts) + 1):
            nodes.setdefault(tuple(ts[:d]), []).append(c)
    kids: dict = {}
    for p in nodes:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    total = {}
    for p in sorted(nodes, key=len, reverse=True):
        leaves = sum(total[k][0] for k in kids.get(p, [])) or 1
        saved = sum(total[k][1] for k in kids.get(p, [])) + (len(nodes[p]) - 1) * (len(p[-1][1].encode()) if p else 0)
        total[p] = (leaves, saved)
    out = []
    for p, cs in nodes.items():
        ends = ",".join(str(c) for c in sorted(cs) if len(again[c]) == len(p))
        out.append((min(cs), len(p), min(nodes[p[:-1]]) if p else None, len(cs), len(kids.get(p, [])), *total[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def conversations(seed=3):
    """Common first turns, a conversation many share, a very long one."""
    rng = random.Random(seed)
    data = []
    for c in range(150):
        data += [(c, t, rng.choice(["user", "assistant"]) if t else "user", rng.choice(["hi", "été", "x" * 30, ""]) if t else "hi") for t in range(rng.randint(1, 8))]
    for c in range(200, 290):
        data += [(c, t, "user", f"same {t}") for t in range(12)]
    data += [(300, t, "user", f"long {t % 3}") for t in range(700)]
    return data


@pytest.mark.parametrize(("limit", "band", "segment", "queue"), [(50_000, 100_000, 4096, 200_000), (40, 3, 5, 4), (400, 50, 64, 1), (0, 7, 100, 100)])
def test_shards_bands_and_spills(spark, limit, band, segment, queue):
    data = conversations()
    if band < 50:
        data = [r for r in data if r[0] != 300 or r[1] < 20]
    assert got(P.trie(frame(spark, data), limit, band, segment, queue)) == brute(data)


def test_defined_cases(spark):
    data = [
        (0, None, "user", "a"), (0, 0, None, None), (0, 0, None, None), (0, 1, "user", "b" * 200_000), (1, 5, "user", "c"), (1, 5, "user", "b"),
        (None, 0, "user", "lost"), (7, 0, "a", "bc"), (8, 0, "ab", "c"), (12, 3, "", ""), (10**15, 1, "user", "far"), (9, None, None, None),
    ]
    assert got(P.trie(frame(spark, data))) == brute(data)
    none = P.trie(frame(spark, []))
    assert none.count() == 0 and none.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def test_the_queue_spills_in_order():
    rng, queue, plain = random.Random(1), P.SpillingQueue(8), []
    for _ in range(3000):
        if plain and rng.random() < 0.45:
            assert queue.peek() == min(plain)
            plain.remove(queue.pop())
        else:
            e = (rng.randrange(50), rng.randrange(50))
            queue.push(e)
            plain.append(e)
    assert [queue.pop() for _ in plain] == sorted(plain) and queue.runs


def test_whole_table(spark):
    from tierwise.llm.registry import QUERIES

    data = [tuple(r) for r in table(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert got(QUERIES["op13_prefix_trie"](spark, SF)) == brute(data)

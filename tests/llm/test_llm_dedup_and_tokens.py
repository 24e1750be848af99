"""Near-duplicate classes against brute force; token files as exact round
trips."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from docs_fixture import EXTRA, empty, frame, rows, words
from pyspark.sql import functions as F

from tierwise.llm import ans_tokens as A
from tierwise.llm import minhash_oph as M
from tierwise.llm.common import LOWER, UPPER, Scratch, shared_path, table, tokenizer_path

SF = "/root/testdata/sf0.01"
WORD = re.compile("[^\x20\x09-\x0d]+")


def shingles(text, size):
    w = WORD.findall((text or "").translate(str.maketrans(UPPER, LOWER)))
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())


def brute(data, size, percent=80):
    """component of each document, over all pairs that share a shingle"""
    sets = {d: shingles(t, size) for d, t in data}
    holders, shared = defaultdict(list), Counter()
    for d, s in sets.items():
        for x in s:
            holders[x].append(d)
    for ds in holders.values():
        shared.update((min(a, b), max(a, b)) for i, a in enumerate(ds) for b in ds[:i])
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {d: (len(s), find(d), find(d) == d) for d, s in sets.items()}


def near_copies(seed=2):
    """Groups whose members are often linked only through others."""
    rng = random.Random(seed)
    data, at = [], 0
    for size in (2, 3, 9, 60):
        base = words(rng, 90).split()
        for _ in range(size):
            w = list(base)
            for _ in range(rng.randint(0, 5)):
                w[rng.randrange(len(w))] = words(rng, 1)
            data.append((at * 7 % 1009, " ".join(w)))
            at += 1
    for n in (1, 2, 3, 4, 5):
        data += [(2000 + n, words(random.Random(n), n)), (3000 + n, words(random.Random(n), n).upper())]
    return data + [(4000 + i, words(rng, 50)) for i in range(20)]


@pytest.mark.parametrize("size", [4, 5])
def test_components_match_brute_force(spark, size):
    data = near_copies()
    docs = spark.createDataFrame(data, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in M.near_duplicates(docs, size).collect()}
    assert got == brute(data, size)
    assert sum(not k for _, _, k in got.values()) > 30


def test_driver_documents_match_brute_force(spark):
    docs = table(spark, SF, "documents")
    data = [(r.doc_id, r.text) for r in docs.collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in M.near_duplicates(docs).collect()}
    assert got == brute(data, 4)


def test_one_large_group_gives_few_pairs(spark):
    """A group of m copies gives at most HEADS * m candidate pairs."""
    m = 300
    members = spark.range(m).selectExpr("id AS rep", "explode(sequence(1L, 20L)) AS bucket")
    assert M._stars(members, range(M.HEADS)).count() <= M.HEADS * m


def _generated(df):
    """Rows that the Generate nodes of a plan made when it ran."""
    df.collect()

    def walk(p):
        kind = p.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return walk(p.executedPlan())
        if kind.endswith("QueryStageExec"):
            return walk(p.plan())
        own = p.metrics().apply("numOutputRows").value() if kind == "GenerateExec" else 0
        return own + sum(walk(p.children().apply(i)) for i in range(p.children().size()))

    return walk(df._jdf.queryExecution().executedPlan())


def test_stars_make_a_pair_once_for_all_its_buckets(spark):
    m, bands = 60, 20
    data = [(i, b) for i in range(m) for b in range(bands)]
    stars = M._stars(spark.createDataFrame(data, "rep long, bucket long").localCheckpoint(), range(M.HEADS))
    assert 0 < _generated(stars) <= M.HEADS * m


def test_small_buckets_give_all_of_their_pairs(spark):
    """Also where the heads of all random orders leave members out."""
    sizes = range(2, M.HEADS + 2)
    data = [(n * 1000 + i, n, n) for n in sizes for i in range(n)]
    got = Counter(r.a // 1000 for r in M._candidates(spark.createDataFrame(data, "rep long, bucket long, n long")).collect())
    assert got == {n: n * (n - 1) // 2 for n in sizes}


def test_rows_without_an_id_all_stay(spark):
    data = [(None, "a b c d e f"), (None, "a b c d e f"), (None, None), (None, None), (1, "x y z"), (1, "x y z"), (2, "x y z")]
    kept = M.drop_near_duplicates(spark.createDataFrame(data, "doc_id long, text string")).collect()
    assert sorted(map(str, kept)) == sorted(map(str, spark.createDataFrame(data[:5], "doc_id long, text string").collect()))


def test_components_of_a_chain(spark):
    edges = spark.range(200).selectExpr("(id * 37) % 200 AS u", "((id + 1) * 37) % 200 AS v")
    with Scratch(spark, "chain") as scratch:
        assert {(r.node, r.root) for r in M.components(edges, scratch).collect()} == {(i, 0) for i in range(1, 200)}


def test_bands_agree_as_often_as_sets_are_alike():
    """Also for small sets, whose bins are mostly densified."""
    rng = np.random.default_rng(3)
    for n in (12, 400):
        same = 0.0
        for _ in range(60):
            pool = np.sort(rng.integers(1 << 63, size=n + n // 8, dtype=np.uint64) * np.uint64(2))
            a, b = pool[: n], pool[n // 8 :]
            a, b = (np.sort(rng.permutation(pool)[:n]) for _ in range(2))
            j = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            same += (M.band_keys(a) == M.band_keys(b)).mean() - j**M.ROWS
        assert abs(same / 60) < 0.05


def test_dedup_defined_cases(spark):
    docs = frame(spark)
    got = defaultdict(list)
    for r in M.near_duplicates(docs).collect():
        got[r.doc_id].append((r.n_shingles, r.component_id, r.kept))
    assert got[100] == [(0, 100, True)]
    assert got[101] == [(0, 101, True)] and got[102] == [(0, 102, True)]
    assert [x[1:] for x in got[104]] == [(0, False)] * 2 and got[105][0][1:] == (1, False)
    assert all(c is None and k for _, c, k in got[None]) and len(got[None]) == 2
    left = M.drop_near_duplicates(docs)
    assert left.columns == docs.columns and {r.rep for r in left.collect()} == {EXTRA[3]}
    ids = sorted(str(r.doc_id) for r in left.collect())
    assert ids == sorted(str(d) for d, *_ in rows() if d not in (104, 105))
    twice = frame(spark, [(1, "a b c d e f g", "en", "s", 0)] * 3)
    assert M.drop_near_duplicates(twice).count() == 1
    several = frame(spark, [(1, "a b c d e f g", "en", "s", 0), (1, "z y x w v u t", "en", "s", 0), (2, "z y x w v u t", "en", "s", 0)])
    assert sorted((r.doc_id, r.component_id) for r in M.near_duplicates(several).collect()) == [(1, 1), (1, 1), (2, 1)]
    assert M.near_duplicates(empty(spark)).count() == 0 and M.drop_near_duplicates(empty(spark)).count() == 0


# -- tokens -------------------------------------------------------------------------


def coded(ids, table_):
    return A.encode_block(np.asarray(ids), [7], [len(ids)], table_)


@pytest.mark.parametrize("n", [1, 2, 255, 256, 5000, 400_000])
def test_blocks_round_trip_whole_and_from_checkpoints(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.zipf(1.3, n), 50_000).astype(np.uint16)
    symbols, counts = np.unique(ids, return_counts=True)
    model = A.FrequencyTable.unpack(A.FrequencyTable.scaled(symbols, counts).pack())
    assert int(model.freq_of.sum()) == 1 << model.bits and model.freq_of.min() >= 1
    frame_ = coded(ids, model)
    docs, sizes, back = A.decode_block(frame_, model)
    assert docs == [7] and sizes.tolist() == [n] and np.array_equal(back, ids)
    marks = A._HEAD.unpack_from(frame_)[5]
    assert np.array_equal(np.concatenate([A.decode_block(frame_, model, only=i)[2] for i in range(marks)]), ids)


def test_blocks_are_near_the_entropy():
    rng = np.random.default_rng(0)
    ids = np.minimum(rng.zipf(1.4, 300_000), 5000).astype(np.uint16)
    symbols, counts = np.unique(ids, return_counts=True)
    p = counts / counts.sum()
    entropy = -(p * np.log2(p)).sum() * len(ids) / 8
    assert len(coded(ids, A.FrequencyTable.scaled(symbols, counts))) < 1.12 * entropy + 20_000


def test_damage_is_noticed():
    model = A.FrequencyTable.scaled(np.array([1, 2]), np.array([3, 5]))
    raw = bytearray(coded([1, 2, 2, 1, 2], model))
    raw[-9] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        A.decode_block(bytes(raw), model)
    table_ = bytearray(model.pack())
    table_[4] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        A.FrequencyTable.unpack(bytes(table_))


def test_skewed_tables_keep_every_symbol():
    model = A.FrequencyTable.scaled(np.arange(40_000), np.concatenate(([10**12], np.ones(39_999, np.int64))))
    ids = np.concatenate((np.zeros(50_000, np.uint16), np.arange(40_000, dtype=np.uint16)))
    assert np.array_equal(A.decode_block(coded(ids, model), model)[2], ids)


def test_pieces_encode_like_whole_texts():
    enc = A.TextEncoder(tokenizer_path(), keep=500)
    rng = random.Random(3)
    parts = [" ", "  ", "\n", "\n\n", "\t", " \n", "a", "the", "The", "'s", ".", ",", "..", "é", "ß", "日本", "9", "<|endoftext|>", "Ġ", "\u00a0", "\u200b", "\x1c",
             "!", "_", "\r\n", "word.\nNext", "end, "]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(14))) for _ in range(4000)]
    for i in range(0, len(texts), 400):
        got = enc.encode(texts[i : i + 400])
        assert got == [np.array(e.ids, "<u2").tobytes() for e in enc.tok.encode_batch(texts[i : i + 400], add_special_tokens=False)]


def test_common_words_outlive_a_full_cache():
    """Words met in call after call are encoded once, however many rare ones
    pass by; a closing mark doesn't make another word."""
    enc = A.TextEncoder(tokenizer_path(), keep=300)
    asked, own = [], enc._ids
    enc._ids = lambda texts: asked.extend(texts) or own(texts)
    common = [f"kept{a}{b}" for a in "bcdfghjklm" for b in "aeiouy"]
    for n in range(12):
        rare = [f"rare{n}x{i}" for i in range(100)]
        texts = [" ".join(["a", *rare, *common, *(w + "," for w in common), "end"])]
        assert enc.encode(texts) == [x.tobytes() for x in own(texts)]
    assert sum(t.count(" keptba") for t in asked) == 1
    assert sum(t.count(" rare5x50") for t in asked) == 1
    assert len(enc.words) <= enc.keep


def expected(data, tok):
    out, start = [], 0
    for d, t in sorted(data, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, A.END_ID]
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_driver_documents_round_trip(spark):
    docs = table(spark, SF, "documents").where("doc_id % 5 = 0")
    tok = A.TextEncoder(tokenizer_path()).tok
    path = A.write_tokens(docs, shared_path(spark, "tokens"), tokenizer_path(), block_tokens=5000)
    want = expected([(r.doc_id, r.text) for r in docs.collect()], tok)
    assert sorted(tuple(r) for r in A.read_tokens(spark, path).collect()) == want
    some = A.read_ids(spark, path).where("doc_id = 10").first()
    assert some.ids == [*tok.encode(docs.where("doc_id = 10").first().text, add_special_tokens=False).ids, A.END_ID]
    assert spark.read.parquet(f"{path}/blocks").count() > 20


def test_token_defined_cases(spark):
    data = [r for r in rows() if r[0] is not None]
    got = sorted(tuple(r) for r in A.tokens_of(frame(spark, data), tokenizer_path()).collect())
    assert got == expected([r[:2] for r in data], A.TextEncoder(tokenizer_path()).tok)
    nulls = A.tokens_of(frame(spark, [(None, None, "en", "s", 0), (3, "x", "en", "s", 0)]), tokenizer_path()).orderBy("start").collect()
    assert [(r.doc_id, r.start, r.n_tokens) for r in nulls] == [(None, 0, 1), (3, 1, 2)]
    assert A.tokens_of(empty(spark), tokenizer_path()).count() == 0
    assert A.tokens_of(frame(spark, data[:3]), tokenizer_path("word_bpe_49k.json")).agg(F.count("*")).first()[0] == 3

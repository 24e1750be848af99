"""Byte-level BPE by overlapping chunks against whole texts."""

import hashlib
import random

import public_tokenizers
import pytest
from docs_fixture import SCHEMA, empty, frame, rows

from tierwise.llm import byte_bpe as B
from tierwise.llm.common import table, tokenizer_path

SF = "/root/testdata/sf0.001"
PATH = tokenizer_path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


def awkward(seed=11):
    rng = random.Random(seed)
    parts = [" ", "  ", "\n", " \n ", "\t", "a", "the", "it's", "'", "'r", "'re", "'ll", "x" * 40, "12345", "...", "é", "日本語", " ", "\x1c", " ", "🙂", "end. "]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 400))) for _ in range(120)]
    runs = ["a" * 900, " " * 700 + "b", "x " + "y" * 500 + " z" * 100 + "?" * 300 + "ok", "\n" * 300, "'" * 333 + "re", "word " * 200, "ab " * 30 + "é" * 200 + " " * 99 + "cd " * 40]
    return [(i, t, None, None, 0) for i, t in enumerate(texts + runs)]


def expected(data):
    c = B.coder(PATH, PATTERN)
    out = []
    for d, t, *_ in data:
        ids = c.encoding.encode_ordinary(t or "")
        out.append((d, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize(("chunk", "overlap"), [(24, 7), (64, 16), (150, 40)])
def test_chunks_encode_like_whole_texts(spark, chunk, overlap):
    data = awkward()
    assert got(B.digests(frame(spark, data), PATH, PATTERN, chunk, overlap)) == expected(data)


def test_defined_cases_and_long_texts(spark):
    data = rows()
    assert got(B.digests(frame(spark, data), PATH, PATTERN)) == expected(data)
    none = B.digests(empty(spark), PATH, PATTERN)
    assert none.count() == 0 and none.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_a_pattern_that_need_not_resynchronise(spark):
    """Pairs of characters: neighbours a whole odd distance apart never agree."""
    data = [(0, "abcdefghij" * 30, None, None, 0), (1, "xy" * 101 + "z", None, None, 0)]
    c = B.coder(PATH, "..?")
    rows_ = B.encode(spark.createDataFrame([(*r, *"kwcrhp") for r in data], SCHEMA), PATH, "..?", 25, 9).collect()
    for d, t, *_ in data:
        ids = [i for r in sorted((r for r in rows_ if r.doc_id == d), key=lambda r: r.no) for i in r.ids]
        assert ids == c.encode(t) and c.decode(ids) == t.encode()


def test_whole_table(spark):
    from tierwise.llm.registry import QUERIES

    docs = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    assert got(QUERIES["op11_byte_bpe"](spark, SF)) == expected(docs)

"""Small documents with the awkward cases: nulls, empty and long texts,
repeated rows, and columns whose names clash with the operators' own."""

import random

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    T.StructField("kept", T.StringType()), T.StructField("n_words", T.StringType()), T.StructField("copies", T.StringType()),
    T.StructField("rep", T.StringType()), T.StructField("hits", T.StringType()), T.StructField("part", T.StringType()),
])
EXTRA = ("k", "w", "c", "r", "h", "p")


def words(rng, n, alphabet="abcdefghij"):
    return [" ".join("".join(rng.choice(alphabet) for _ in range(rng.randint(2, 7))) for _ in range(n))][0]


def rows(seed=7):
    rng = random.Random(seed)
    texts = [words(rng, rng.randint(1, 120)) for _ in range(40)]
    out = [(i, t, "en", f"s{i % 3}", len(t)) for i, t in enumerate(texts)]
    out += [
        (100, None, None, None, None),
        (101, "", "en", "s0", 0),
        (102, " \n\t \n", "en", None, 5),
        (103, words(rng, 60_000), "en", "s1", 0),
        (None, words(rng, 70), "en", "s1", 0),
        (None, None, "de", "s2", 0),
        (104, texts[0], "en", "s0", 0),
        (104, texts[0], "en", "s0", 0),
        (105, texts[1].upper(), "en", "s2", 0),
    ]
    return out


def frame(spark, data=None):
    data = rows() if data is None else data
    return spark.createDataFrame([(*r, *EXTRA) for r in data], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)

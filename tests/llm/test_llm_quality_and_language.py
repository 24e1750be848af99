"""Line field and language field: counts against brute force, the recurrences
against enumeration, verdicts and accuracy on the driver's data."""

import itertools
import re
from collections import Counter

import numpy as np
from docs_fixture import empty, frame, rows, words
from pyspark.sql import functions as F

from tierwise.llm import lang_crf as L
from tierwise.llm import quality_crf as Q
from tierwise.llm.common import table
from tierwise.llm.crf import Packing, forward_backward, viterbi

SF = "/root/testdata/sf0.01"
WORD = re.compile("[^\x20\x09-\x0d]+")


def brute_counts(text):
    text = text or ""
    w = WORD.findall(text)
    often = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {j for i in range(len(w) - 2) if often[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines, dups = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dups += line in lines
            lines.add(line)
    n, r = len(w), len(covered)
    return (n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dups, r, n < 50 or 100 * r > 50 * n)


def test_recurrences_match_enumeration():
    rng = np.random.default_rng(1)
    lengths = [3, 1, 4, 2]
    scores, trans, start = rng.normal(size=(10, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    post, log_z, pairs = forward_backward(Packing(lengths), scores, trans, start, pairs=True)
    best = viterbi(Packing(lengths), scores, trans, start)
    lo, total, seen = 0, 0.0, np.zeros((3, 3))
    for n in lengths:
        s = scores[lo : lo + n]
        paths = list(itertools.product(range(3), repeat=n))
        value = lambda p, s=s, n=n: start[p[0]] + sum(s[i, p[i]] for i in range(n)) + sum(trans[p[i], p[i + 1]] for i in range(n - 1))
        weight = np.exp([value(p) for p in paths])
        total += np.log(weight.sum())
        weight /= weight.sum()
        for i in range(n):
            for k in range(3):
                assert abs(post[lo + i, k] - sum(w for w, p in zip(weight, paths, strict=True) if p[i] == k)) < 1e-9
        for w, p in zip(weight, paths, strict=True):
            for i in range(n - 1):
                seen[p[i], p[i + 1]] += w
        assert tuple(best[lo : lo + n]) == max(paths, key=value)
        lo += n
    assert abs(total - log_z) < 1e-9 and np.allclose(seen, pairs)


def test_counts_match_brute_force(spark):
    data = rows() + [(200, "a b c a b c a b c\nx\nx\n\nx", "en", "s", 0), (201, "a a a a", "en", "s", 0), (202, "é #1 $2\x0b%3 <b>", "en", "s", 0)]
    got = Counter(tuple(r)[:7] for r in Q.score(frame(spark, data), Q.LineField()).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect())
    assert got == Counter((d, *brute_counts(t)) for d, t, *_ in data)


def test_quality_verdicts_on_labelled_documents(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = Q.train(docs, labels, max_docs=250)
    judged = Q.score(docs, model).join(labels, "doc_id").where("not base_failed").collect()
    held = [r for r in judged]
    assert all(r.kept for r in held if r.quality == 1)
    assert not any(r.kept for r in held if r.quality == 0) and any(r.quality == 0 for r in held)


def test_quality_defined_cases(spark):
    docs = frame(spark)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert Q.train(docs, none).emit.any() == np.False_
    one_class = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (None, 0, 0)], "doc_id long, quality int, toxic int")
    assert not Q.train(docs, one_class).emit.any()
    kept = Q.keep(docs, Q.LineField())
    assert kept.columns == docs.columns
    expect = sorted(str(d) for d, t, *_ in rows() if not brute_counts(t)[5])
    assert sorted(str(r.doc_id) for r in kept.collect()) == expect
    assert Q.score(empty(spark), Q.LineField()).count() == 0 and Q.keep(empty(spark), Q.LineField()).count() == 0


def test_language_held_out_accuracy(spark):
    docs = table(spark, SF, "documents")
    model = L.train(docs, per_language=60, epochs=6)
    rows_ = L.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null").collect()
    assert len(rows_) > 100
    assert sum(r.lang_pred == r.lang for r in rows_) / len(rows_) >= 0.97


def test_language_of_words_in_switched_text(spark):
    """Posteriors change language inside a text."""
    docs = table(spark, SF, "documents")
    model = L.train(docs, per_language=40, epochs=5)
    pick = {lang: docs.where((F.col("lang") == lang) & (F.length("text") > 2000)).orderBy("doc_id").first().text for lang in ("de", "en")}
    first, second = (" ".join(pick[k].split()[:80]) for k in ("de", "en"))
    feats = L.features([first + " " + second])
    post = forward_backward(Packing(feats[0]), L.emissions(feats, model.emit), model.trans, model.start)
    label = post.argmax(axis=1)
    de, en = model.langs.index("de"), model.langs.index("en")
    half = len(label) // 2
    assert (label[: half - 5] == de).mean() > 0.9 and (label[half + 5 :] == en).mean() > 0.9


def test_language_defined_cases(spark):
    nothing = L.train(empty(spark))
    assert [tuple(r) for r in L.predict(frame(spark, [(1, "abc", "en", "s", 0)]), nothing).collect()] == [(1, False, "und", 0.0)]
    data = [(i, words(__import__("random").Random(i), 30, "abcd" if i % 2 else "wxyz"), "aa" if i % 2 else "zz", "s", 0) for i in range(60)]
    data += [(100, None, "aa", "s", 0), (101, "", "aa", "s", 0), (102, "12 + 3 = !", "aa", "s", 0), (None, "abcd dcba", None, "s", 0), (103, "wxyz " * 40_000, None, "s", 0)]
    docs = frame(spark, data)
    got = {r.doc_id: r for r in L.predict(docs, L.train(docs)).collect()}
    assert {got[i].lang_pred for i in (100, 101, 102)} == {"und"} and got[100].score == 0.0
    assert got[None].lang_pred == "aa" and got[None].held_out is True and got[103].lang_pred == "zz"
    assert all(0 <= r.score <= 1 for r in got.values())
    assert L.predict(empty(spark), L.train(docs)).count() == 0


def test_every_language_is_learned(spark):
    names = [f"l{i:03d}" for i in range(203)]
    data = [(i * 10 + j, " ".join([chr(0x4E00 + i) * 3] * 12), lang, "s", 0) for i, lang in enumerate(names) for j in range(3 if i < 200 else 2)]
    docs = frame(spark, data)
    usable = {r.lang for r in docs.where(~L.held_out(F.col("doc_id"))).select("lang").distinct().collect()}
    model = L.train(docs, epochs=3)
    assert set(model.langs) == usable and len(usable) > 200
    rare = docs.where(F.col("lang") >= "l200")
    got = L.predict(rare, model).join(rare.select("doc_id", "lang"), "doc_id").where(F.col("lang").isin(sorted(usable))).collect()
    assert got and all(r.lang_pred == r.lang for r in got)

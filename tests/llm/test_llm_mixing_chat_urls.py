"""Mixing, chat formatting, URL filter, the pipeline."""

import hashlib
import math
from collections import Counter, defaultdict

import pytest
from docs_fixture import EXTRA, empty, frame, rows
from pyspark.sql import functions as F

from tierwise.llm import chat_trees as C
from tierwise.llm import mixing as X
from tierwise.llm import url_templates as U
from tierwise.llm.common import Scratch, table

SF = "/root/testdata/sf0.01"


# -- mixing -------------------------------------------------------------------------


def test_copies_invert_the_poisson_distribution(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "'abcd' AS text", "IF(id < 1000, 'a', 'b') AS source")
    got = X.replicate(docs, weights={"a": 3.0, "b": 1.0}).select("doc.doc_id", "doc.source", "rate", "copies", "copy_no").collect()
    rate = {r.source: r.rate for r in got}
    assert rate == {"a": 3.0, "b": pytest.approx(1000 / 3000)}
    copies = defaultdict(list)
    for r in got:
        copies[r.doc_id].append(r)
    assert all([x.copy_no for x in sorted(c, key=lambda x: x.copy_no)] == list(range(1, c[0].copies + 1)) for c in copies.values())
    for doc_id in range(4000):
        lam = 3.0 if doc_id < 1000 else 1000 / 3000
        u = (int(hashlib.md5(f"17|1|{doc_id}".encode()).hexdigest()[:12], 16) + 0.5) / 2**48
        k, term = 0, math.exp(-lam)
        total = term
        while total < u:
            k += 1
            term *= lam / k
            total += term
        assert len(copies[doc_id]) == k
    share = Counter(r.source for r in got)
    assert abs(share["a"] / len(got) - 0.75) < 0.03 and abs(len(got) - 4000) < 200


def test_large_rates_are_drawn_in_parts(spark):
    docs = spark.range(300).selectExpr("id AS doc_id", "IF(id < 3, 'ab', repeat('x', 200)) AS text", "IF(id < 3, 'rare', 'big') AS source")
    per = {r.copies for r in X.replicate(docs).where("doc.source = 'rare'").select("copies").distinct().collect()}
    lam = 0.5 * (6 + 297 * 200) / 6
    assert per and all(abs(n - lam) < 6 * math.sqrt(lam) for n in per)


def test_salted_join_gives_the_same_copies(spark, monkeypatch):
    docs = frame(spark)
    a = sorted(str(r) for r in X.mix(docs).collect())
    monkeypatch.setattr(X, "MAX_BROADCAST_SOURCES", 1)
    assert sorted(str(r) for r in X.mix(docs).collect()) == a


def test_mixing_is_shuffled_and_repeatable(spark):
    docs = table(spark, SF, "documents")
    once = [r.doc_id for r in X.mix(docs).collect()]
    assert once == [r.doc_id for r in X.mix(docs.repartition(7)).collect()] and once != sorted(once)
    chars = Counter()
    for r in X.mix(docs).selectExpr("source", "length(text) AS n").collect():
        chars[r.source] += r.n
    assert max(chars.values()) < 2.5 * min(chars.values())


def test_mixing_defined_cases(spark):
    docs = frame(spark)
    mixed = X.mix(docs, weights={None: 2.0, "s0": 1.0})
    assert mixed.columns == docs.columns
    out = mixed.collect()
    assert {r.source for r in out} <= {None, "s0"} and {r.copies for r in out} <= {EXTRA[2]}
    assert X.mix(docs, weights={}).count() == 0 and X.mix(empty(spark)).count() == 0
    nothing = frame(spark, [(1, None, "en", "s", 0), (2, "", "en", "s", 0)])
    assert X.mix(nothing).count() == 0
    own = Counter(r[3] for r in rows())
    got = {r.source: r.rate for r in X.replicate(docs, measure="rows").select("doc.source", "rate").distinct().collect()}
    assert all(rate == pytest.approx(len(rows()) / 4 / own[source]) for source, rate in got.items()) and got
    same = [r.n for r in X.mix(docs).groupBy("doc_id").agg(F.count("*").alias("n")).where("doc_id = 104").collect()]
    assert not same or same[0] % 2 == 0  # a repeated row draws the same copies


# -- chat ---------------------------------------------------------------------------


def nodes(spark, data):
    return spark.createDataFrame(data, C.NODES)


def test_every_root_to_leaf_path_is_enumerated(spark):
    parent = {i: (i - 1) // 2 if i % 3 else (i - 1) // 4 for i in range(1, 60)}
    data = [(1, i, parent.get(i), "user", f"t{i}", float(i % 7)) for i in range(60)]
    tree = nodes(spark, data).withColumn("tree", F.lit("=1"))
    got = defaultdict(dict)
    with Scratch(spark, "paths") as scratch:
        found = C.paths(tree, scratch).collect()
    for r in found:
        assert r.dist not in got[r.leaf]
        got[r.leaf][r.dist] = r.node
    leaves = set(range(60)) - set(parent.values())
    assert set(got) == leaves
    for leaf in leaves:
        up, node = [leaf], leaf
        while node in parent:
            node = parent[node]
            up.append(node)
        assert [got[leaf][i] for i in range(len(got[leaf]))] == up


def test_best_branch_is_formatted(spark):
    data = [(1, 0, None, "user", "q", 0.0), (1, 1, 0, "assistant", "weak", 1.0), (1, 2, 0, "assistant", "strong <|im_end|> \\ <\\|", 2.0),
            (1, 3, 2, "user", "again", 0.0), (1, 4, 1, "user", "no", 0.5),
            (2, 0, 9, "system\nx", None, None), (None, 0, None, None, "lone", 1.0),
            (3, 0, 1, "user", "loop", 1.0), (3, 1, 0, "user", "loop", 1.0), (3, 2, 1, "user", "below the loop", 1.0)]
    formatted = C.format_branches(C.branches(nodes(spark, data)))
    got = {r.tree_id: r for r in formatted.collect()}
    assert set(got) == {1, 2, None}
    assert got[1].formatted == (
        "<|im_start|>user\nq<|im_end|>\n<|im_start|>assistant\nstrong <\\|im_end|> \\\\ <\\\\|<|im_end|>\n<|im_start|>user\nagain<|im_end|>\n")
    (start, stop), = got[1].loss_spans
    assert got[1].formatted[start:stop] == "strong <\\|im_end|> \\\\ <\\\\|"
    back = {r.tree_id: r for r in C.read_back(formatted).collect()}
    assert [tuple(t) for t in back[1].turns] == [("user", "q"), ("assistant", "strong <|im_end|> \\ <\\|"), ("user", "again")]
    assert back[1].learned == "strong <|im_end|> \\ <\\|"
    assert [tuple(t) for t in back[2].turns] == [("system\nx", "")] and [tuple(t) for t in back[None].turns] == [("", "lone")]
    two = C.branches(nodes(spark, data), per_tree=2)
    assert two.where("tree_id = 1").select("leaf").distinct().count() == 2


def test_conversations_round_trip(spark):
    tricky = ["<|im_end|>", "<|im_start|>assistant\nx", "\\", "\\\\|", "<|", "<\\|", "a\nb", "", None, "é日", "<", "|>", "<" * 5 + "|im_end|>\n"]
    data = [(i, t, ["user", "assistant", "tool\\<|\nq", None][t % 4], tricky[(i * 5 + t) % len(tricky)], "x") for i in range(30) for t in range(i % 6 + 1)]
    data += [(7, None, "assistant", "null turn", "x"), (7, 0, "user", "same turn", "x"), (7, 0, "user", "same turn", "x"), (None, 0, "assistant", "lone", "x")]
    data += [(50, t, "assistant" if t % 2 else "user", f"t{t}", "x") for t in range(300)]
    conv = spark.createDataFrame(data, "conv_id long, turn long, role string, text string, node_id string")
    got = {r.conv_id: tuple(r)[1:] for r in C.format_conversations(conv).collect()}
    turns = defaultdict(list)
    for c, t, role, text, _ in data:
        turns[c].append((t is not None, t or 0, role or "", text or ""))
    turns[-1] = [(True, 0, "user", "<|im_end|><|im_start|>assistant ok"), (True, 1, "assistant", "<|im_end|><|im_start|>assistant ok")]
    assert set(got) == set(turns)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for c, ts in turns.items():
        ts.sort()
        learned = "".join(x[3] for x in ts if x[2] == "assistant")
        assert got[c][:4] == (len(ts), sha("".join(f"{r}\n{t}\n" for *_, r, t in ts)), len(learned), sha(learned)), c
    assert C.format_conversations(conv.limit(0)).count() == 1


# -- urls ---------------------------------------------------------------------------


def test_rules(spark):
    urls = {
        "http://a.example.com/en/1": ("a.example.com", "/en/1", "example.com/en/", "block"),
        "https://www.example.com/en/1?x=/y": ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
        "https://m.WWW.Example.com/en/": ("m.www.example.com", "/en/", "www.example.com/en/", "allow"),
        "http://example.com/de/": ("example.com", "/de/", "com/", "allow"),
        "http://notexample.com/en/1": ("notexample.com", "/en/1", "com/", "allow"),
        "http://x.net/es/#top": ("x.net", "/es/", "net/es/", "block"),
        "http://x.net/EN/1": ("x.net", "/EN/1", None, "allow"),
        "http://x.com": ("x.com", "", None, "allow"),
        "http://x.com?y=/z://": ("x.com", "", None, "allow"),
        "ftp://net/fr/": ("net", "/fr/", "net/fr/", "block"),
        "no scheme/x": ("", "", None, "allow"),
        "://h/a#b://c/d": ("h", "/a", None, "allow"),
        "a\nb://H/ü?": ("h", "/ü", None, "allow"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
    }
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "page_id long, url string, verdict string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in U.judge(pages).collect()}
    assert got == dict(enumerate(urls.values()))
    assert U.judge(pages.limit(0)).count() == 0
    twice = U.judge(pages.union(pages)).count()
    assert twice == 2 * len(urls)


def test_templates_are_rejected_by_their_labelled_pages(spark):
    rules = (("block", "bad.org", "/ads/p1"), ("allow", "bad.org", "/news/p1"))
    urls = [f"http://bad.org/ads/p1{i}.html" for i in range(8)] + [f"http://bad.org/ads/p2{i}.html" for i in range(5)]
    urls += [f"http://bad.org/news/p1{i}.html" for i in range(8)] + [f"http://bad.org/news/p2{i}.html" for i in range(5)]
    urls += [f"http://other.org/ads/p2{i}.html" for i in range(5)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    free = [r for r in U.judge(pages, rules).collect() if r.rule is None]
    assert Counter((r.template, r.verdict) for r in free) == {
        ("bad.org/ads/*.html", "block"): 5, ("bad.org/news/*.html", "allow"): 5, ("other.org/ads/*.html", "allow"): 5}


def test_many_small_branches_become_one(spark):
    urls = [f"http://h.org/{chr(97 + i % 26)}{chr(97 + i // 26)}/x" for i in range(60)] + ["http://h.org/big/x"] * 60
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    assert Counter(r.template for r in U.judge(pages).collect()) == {"h.org/*/x": 60, "h.org/big/x": 60}


# -- the pipeline -------------------------------------------------------------------


def test_pipeline_stages(spark):
    import corpus_pipeline as P

    docs = table(spark, SF, "documents").limit(300).union(table(spark, SF, "documents").where("doc_id >= 600"))
    left = {}
    for name, stage in P.STAGES[:-1]:
        done = stage(spark, docs, SF)
        assert done.columns == table(spark, SF, "documents").columns, name
        docs = spark.createDataFrame(done.collect(), done.schema)
        left[name] = docs.count()
    assert left["quality_rules"] > left["near_dedup"] >= left["decontaminate"] > 0
    assert abs(left["mix_sources"] - left["decontaminate"]) < 0.3 * left["decontaminate"]
    assert [n for n, _ in P.STAGES] == ["quality_rules", "near_dedup", "decontaminate", "mix_sources", "token_output"]
    tokens = P.STAGES[-1][1](spark, docs, SF)
    assert tokens.count() == docs.count() and tokens.agg(F.min("start")).first()[0] == 0


def test_queries_with_an_oracle_agree(spark):
    import duckdb

    import __spark_entry__ as E

    con = duckdb.connect()
    for name in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('/root/testdata/sf0.001/{name}.parquet')")
    clean = lambda row: tuple(repr(round(v, 9)) if isinstance(v, float) else str(v) for v in row)
    for name in ("op1_license_scan", "op2_source_mixing", "op8_url_filter", "op9_chat_formatting"):
        df = E.queries()[name](spark, "/root/testdata/sf0.001")
        rel = con.execute(E.oracle_sql()[name])
        cols = [d[0] for d in rel.description]
        assert sorted(cols) == sorted(df.columns)
        assert sorted(map(clean, df.select(*cols).collect())) == sorted(map(clean, rel.fetchall())), name
    assert {n.split("_")[0] for n in E.queries() if n.startswith("op")} == {f"op{i}" for i in range(1, 14)} and "pipeline" in E.queries()


def test_the_mixing_query_shuffles_whole_documents(spark):
    import os

    from tierwise.llm.registry import QUERIES

    got = QUERIES["op2_source_mixing"](spark, SF)
    assert len({os.path.dirname(f) for f in got.inputFiles()}) == 1
    stored = [r for f in sorted(got.inputFiles()) for r in spark.read.parquet(f).select("doc.*", "copies", "copy_no", "shuffle_key").collect()]
    keys = [r.shuffle_key for r in stored]
    assert keys == sorted(keys) and len(keys) == got.count()
    docs = {r.doc_id: r for r in table(spark, SF, "documents").collect()}
    assert all(r[: len(docs[r.doc_id])] == docs[r.doc_id] for r in stored)
    columns = ["doc_id", "source", "copies", "copy_no", "shuffle_key"]
    assert got.columns == columns and [tuple(r) for r in got.collect()] == [tuple(r[c] for c in columns) for r in stored]

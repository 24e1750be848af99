"""HTML extraction, license scan, decontamination: small cases and the
driver's data against plainer code."""

import html
import random
import re

import numpy as np
from docs_fixture import EXTRA, empty, frame, rows, words

from tierwise.llm import html_density as H
from tierwise.llm import license_join as J
from tierwise.llm import qgram_leaks as G
from tierwise.llm.common import LOWER, UPPER, table

SF = "/root/testdata/sf0.01"


# -- HTML ---------------------------------------------------------------------------


def test_pages_give_their_article(spark):
    pages = table(spark, SF, "pages")
    page = {r.page_id: r.html for r in pages.collect()}
    for r in H.extract(pages).collect():
        body = re.search("<article>(.*?)</article>", page[r.page_id], re.S).group(1)
        body = re.sub("<[^>]+>", "", re.sub("</?(p|br|h1)>", "\n", body))
        assert r.text == " ".join(html.unescape(body).split()) and r.n_chars == len(r.text)


def test_html_parts_that_are_not_the_article():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="<p>x</p>";</script></head>
    <body class="has-sidebar"><header>Site</header><nav><a href=x>Home</a></nav><div class="cookie-notice">Accept</div>
    <form><label>Mail</label><input></form><aside>Side</aside><main><article><h1>A &amp; B</h1><p>One <b>two</b>&nbsp;three<br>four
    <p>Five<div class="ad banner">Buy</div><ul><li>Six</li></ul><section id=comments><p>First!</p></section></article></main>
    <footer>&copy; me</footer></body></html>"""
    assert H.main_text(page) == "A & B One two three four Five Six"


def test_html_without_article_takes_the_dense_container():
    text = "long words of content " * 12
    page = f"<html><body><div id=menu><a>a</a><a>b</a></div><div><p>{text}</p><p>short</p><p>{text}</p></div><div class=footer>c</div></body></html>"
    assert H.main_text(page) == " ".join(f"{text} short {text}".split())


def test_html_without_article_keeps_lists_tables_and_sections():
    text = "long words of content " * 12
    items = "".join(f"<li>i{n}</li>" for n in range(9))
    cells = "".join(f"<tr><td>c{n}</td><td>d{n}</td></tr>" for n in range(5))
    inner = f"<div><p>{text}</p></div><ul>{items}</ul><table>{cells}</table><div><h2>Sub</h2><div>tiny</div></div><blockquote>{text}</blockquote><div>{text}</div>"
    page = f"<html><body><div><span>site</span></div><div class=menu>m</div><div>{inner}</div><div>x</div></body></html>"
    want = [text, *(f"i{n}" for n in range(9)), *(f"c{n} d{n}" for n in range(5)), "Sub", "tiny", text, text]
    assert H.main_text(page) == " ".join(" ".join(want).split())
    one = f"<body><div>a</div><section><ul><li>first</li><li>{text}</li><li>last</li></ul></section><div>b</div></body>"
    assert H.main_text(one) == " ".join(f"first {text} last".split())


def test_html_takes_every_article():
    text = "long words of content " * 12
    assert H.main_text(f"<body><article><p>{text}</p></article><article><p>short</p></article>x</body>") == " ".join(f"{text} short".split())


def test_html_defined_cases(spark):
    assert H.main_text(None) == H.main_text("") == H.main_text("<nav>x</nav>") == H.main_text("<!-- x") == ""
    assert H.main_text("plain text only") == "plain text only"
    assert H.main_text("<article><p>cut off in the mid") == "cut off in the mid"
    assert H.main_text("<form><article><p>inside a page-wide form</p></article></form>") == "inside a page-wide form"
    big = "<article>" + "<p>word word</p>" * 30_000
    assert H.main_text(big) == " ".join(["word word"] * 30_000)
    pages = spark.createDataFrame([(1, "u", "<article>é</article>", "x"), (1, "u", "<article>é</article>", "x"), (None, None, None, None)],
                                  "page_id long, url string, html string, text string")
    got = sorted((str(r.page_id), r.text, r.n_chars) for r in H.extract(pages).collect())
    assert got == [("1", "é", 1), ("1", "é", 1), ("None", "", 0)]
    assert H.extract(pages.limit(0)).count() == 0


# -- licenses -----------------------------------------------------------------------


def brute_scan(text):
    w = re.findall(J.WORD, (text or "").translate(str.maketrans(UPPER, LOWER)))
    at, own = [], set()
    for phrase, label in J.PHRASES:
        p = phrase.split()
        here = [i for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
        at += here
        own |= {label} if here else set()
    found, best = set(own), 1.0 if at else 0.0
    for lo in range(0, len(w), J.STRIDE):
        block = set(w[lo : lo + J.BLOCK])
        for label, s in J.template_sets():
            n = len(block & set(s))
            if n >= J.needed(len(s), J.THRESHOLD):
                found.add(label)
                best = max(best, n / len(s))
    return (len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(own)), ",".join(sorted(found)), best)


def test_license_scan_matches_every_block_against_every_template(spark):
    rng = random.Random(3)
    data = list(rows())
    for i, (_, text) in enumerate(J.TEMPLATES * 4):
        parts = text.split()
        for _ in range(rng.randint(0, 3)):
            parts[rng.randrange(len(parts))] = rng.choice(["x", "the", "license", "mit"])
        data.append((300 + i, words(rng, rng.randint(0, 90)) + "\n" + " ".join(parts) + ". " + words(rng, rng.randint(0, 90)), "en", "s", 0))
    data += [(400, "Under the MIT License, under THE mit license; Apache License, Version 2.0", "en", "s", 0), (401, "mit mit mit", "de", "s", 0),
             (402, "CC BY-NC", "en", "s", 0), (403, "license", "en", "s", 0)]
    got = sorted(str(tuple(r)) for r in J.scan(frame(spark, data)).collect())
    assert got == sorted(str((d, *brute_scan(t))) for d, t, *_ in data)
    assert J.scan(empty(spark)).count() == 0


def test_license_words_are_those_of_the_word_class_for_every_character(spark):
    """The ranges that Spark searches for and the class that the SQL names."""
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = [(i, " ".join(f"{chr(c)}x{chr(c)}Y" for c in points[i : i + 4096])) for i in range(0, len(points), 4096)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    found = {r.doc_id: r.words for r in J._with_words(docs).collect()}
    assert found == {i: re.findall(J.WORD, t.translate(str.maketrans(UPPER, LOWER))) for i, t in texts}
    assert not re.search(r"\[\^", J.RUNS)


# -- decontamination ------------------------------------------------------------------


def edit(rng, text, n):
    out = list(text)
    for _ in range(n):
        at, kind = rng.randrange(len(out)), rng.randrange(3)
        if kind == 0:
            out[at] = rng.choice("klmnop")
        elif kind == 1:
            del out[at]
        else:
            out.insert(at, rng.choice("klmnop"))
    return "".join(out)


def distance_to_some_stretch(pattern, text):
    """Plain edit distance of the pattern to its best stretch of the text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern):
        new = [i + 1]
        for j, d in enumerate(text):
            new.append(min(row[j] + (c != d), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def test_alignment_matches_the_plain_recurrence():
    rng = random.Random(11)
    for _ in range(60):
        pattern = words(rng, 12)[:60]
        k = int(len(pattern) * G.EDIT_SHARE)
        at = rng.randint(0, 40)
        text = words(rng, 20)[:at] + edit(rng, pattern, rng.randint(0, k + 3)) + words(rng, 10)
        exact = distance_to_some_stretch(pattern, text)
        lo = max(0, at - k)
        got = G.align(np.array([ord(c) for c in pattern], np.uint32), np.array([ord(c) for c in text], np.uint32), lo, k)
        assert got >= min(exact, k + 1)
        if exact <= k:
            assert got == exact, (pattern, text)


def test_edited_passages_are_found_and_clean_documents_left_alone():
    rng = random.Random(5)
    items = [(i, words(rng, 45)) for i in range(40)]
    index = G.build_index(items)
    dirty = [words(rng, 60).upper() + "\n\n" + edit(rng, t, int(len(t) * 0.04)) + " " + words(rng, 30) for _, t in items]
    exact = [t.replace(" ", "  \n") for _, t in items]
    clean = [words(rng, 200) for _ in range(100)]
    assert all(i in [x for x, *_ in hits] for (i, _), hits in zip(items, G.search(dirty, index), strict=True))
    assert [[x[:2] for x in hits] for hits in G.search(exact, index)] == [[(i, 0)] for i, _ in items]
    assert not any(G.search(clean, index))


def test_driver_passages_are_found_whole(spark):
    docs, bench = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    passages = {r.item_id: G.normalise(r.text) for r in bench.collect()}
    truth = {r.doc_id: {i for i, p in passages.items() if p in G.normalise(r.text)} for r in docs.collect()}
    got = G.find_leaks(docs, bench).collect()
    assert len(got) == len(truth) and sum(r.contaminated for r in got) >= 20
    for r in got:
        assert {int(x) for x in r.item_ids.split(",") if x} == truth[r.doc_id] and r.n_items == len(truth[r.doc_id])


def test_leaks_in_parts_and_defined_cases(spark):
    rng = random.Random(9)
    long = words(rng, 40)
    bench = spark.createDataFrame([(1, long, "x"), (2, None, "x"), (3, "too short", "x"), (None, words(rng, 30), "x"), (4, words(rng, 50), "x"), (4, words(rng, 50), "x")],
                                  "item_id long, text string, hits string")
    data = rows() + [(500, f"a {long} b", "en", "s", 0), (500, f"a {long} b", "en", "s", 0)]
    docs = frame(spark, data)
    whole = sorted(map(str, G.find_leaks(docs, bench).collect()))
    assert whole == sorted(map(str, G.find_leaks(docs, bench, max_index_chars=300).collect()))
    flagged = [r for r in G.find_leaks(docs, bench).collect() if r.contaminated]
    assert [(r.doc_id, r.item_ids, r.best_distance) for r in flagged] == [(500, "1", 0)] * 2
    left = G.drop_leaks(docs, bench, max_index_chars=300)
    assert left.columns == docs.columns and left.count() == len(rows()) and {r.hits for r in left.collect()} == {EXTRA[4]}
    assert G.find_leaks(empty(spark), bench).count() == 0 and G.find_leaks(docs, bench.limit(0)).where("contaminated").count() == 0


def test_quotes_of_a_window_are_found_at_every_offset():
    rng = random.Random(21)
    item = words(rng, 70)[:259] + "k"
    index = G.build_index([(1, item)])
    quotes = [words(rng, 30) + " " + item[at : at + G.WINDOW] + " " + words(rng, 30) for at in range(len(item) - G.WINDOW + 1)]
    assert [[x[:2] for x in hits] for hits in G.search(quotes, index)] == [[(1, 0)]] * len(quotes)
    # with as many edits as the budget allows, wherever the quote begins
    k = int(G.WINDOW * G.EDIT_SHARE)
    for at in range(0, len(item) - G.WINDOW, 7):
        (hits,) = G.search([words(rng, 20) + " " + edit(rng, item[at : at + G.WINDOW], k) + " " + words(rng, 20)], index)
        assert [i for i, *_ in hits] == [1] and hits[0][1] <= k


def test_windows_found_match_the_plain_recurrence():
    rng = random.Random(22)
    item = words(rng, 40)[:149] + "k"
    index, k = G.build_index([(1, item)]), int(G.WINDOW * G.EDIT_SHARE)
    for n in (0, 3, 8, 12):
        text = G.normalise(words(rng, 15) + " " + edit(rng, item[20:135], n) + " " + words(rng, 15))
        exact = [distance_to_some_stretch(item[s : s + G.WINDOW], text) for s in range(len(item) - G.WINDOW + 1)]
        near = [d for d in exact if d <= k]
        (hits,) = G.search([text], index)
        assert hits == ([(1, min(near), len(near))] if near else [])


def test_long_license_templates_are_found_wherever_they_begin(spark):
    """Templates far longer than a default block, at every kind of offset."""
    long = " ".join(f"w{i}" for i in range(300))
    middle = " ".join(f"v{i}" for i in range(50))
    templates = (("long", long), ("middle", middle), ("none", " - "))
    texts = {}
    for begin in (0, 1, 24, 63, 150, 299, 301, 1000):
        texts[begin] = " ".join(["x"] * begin + [long] + ["y"] * 40)
        texts[5000 + begin] = " ".join(["x"] * begin + [middle])
        texts[10000 + begin] = " ".join(["x"] * begin + long.split()[:200])  # two thirds of it
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.labels for r in J.scan(docs, templates=templates).collect()}
    assert got == {i: "long" if i < 5000 else "middle" if i < 10000 else "" for i in texts}


def test_html_with_tags_that_never_close_takes_linear_time():
    from time import perf_counter

    began = perf_counter()
    assert H.main_text("<article>" + "<i>x " * 50000) == " ".join(["x"] * 50000)
    assert H.main_text("<article><p>a<div>" + "<i>x " * 20000 + "<p>y</p>" * 20000).count("y") == 20000
    assert perf_counter() - began < 30

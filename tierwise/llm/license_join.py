"""License scan: an exact set-similarity join of text blocks and templates.

A text's words are cut into overlapping blocks of twice the longest
template's words (64 at least), so every copy of a template lies whole in one.  A block matches a template
if it contains at least ``threshold`` of the template's distinct words.  The
join is exact: all template words are ordered by their frequency in the whole
corpus, rarest first, and a block can only reach the threshold if it holds
one of the first ``n - needed + 1`` words of the template (prefix filter), has
enough template words at all (length filter), and has enough left after the
shared word on both sides (positional filter); what remains is counted in
full.  The templates are a fixed, small table, so they are joined as a
broadcast.

Beside the method, the places of three fixed phrases are counted, anywhere in
the text.  Only DataFrame expressions are used.

Defined cases: a null text is empty and has no words; the matches depend on
the text alone, so repeated rows and repeated texts get the same answer; a
null ``doc_id`` is carried; columns besides ``doc_id`` and ``text`` are
ignored.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwise.llm.common import LOWER, UPPER, ascii_lower

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: the same words of lower-cased text; Java takes a third of the time for the ranges that are meant
RUNS = r"[0-9a-z\x{80}-\x{10FFFF}]+"
BLOCK, STRIDE = 64, 32  # at least, see stride_for

# fixed values: phrases of the base count and the labels they stand for
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

# fixed values: notices of public licenses
TEMPLATES = (
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    ("apache-2", "you may not use this file except in compliance with the License"),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
)
THRESHOLD = 0.85


def _tokens(text: str) -> list[str]:
    return re.findall(WORD, text.translate(str.maketrans(UPPER, LOWER)))


def template_sets(templates=TEMPLATES) -> list[tuple[str, list[str]]]:
    """Distinct words of each template; one without words matches nothing."""
    return [(label, sorted(set(_tokens(text)))) for label, text in templates if _tokens(text)]


def stride_for(templates) -> int:
    """Words from one block to the next.  Blocks are two strides long, so any
    passage of up to a stride and a word lies whole in one of them, and the
    longest template does."""
    return max([STRIDE, *(len(_tokens(text)) for _, text in templates)])


def needed(n: int, threshold: float) -> int:
    """Shared words that reach the threshold of a template of n words."""
    return next(k for k in range(1, n + 1) if k >= threshold * n - 1e-9)


def _array(items) -> Column:
    return F.array(*(F.lit(x) for x in items))


def _with_words(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.md5(text.cast("binary")).alias("digest"),
                       F.regexp_extract_all(ascii_lower(text), F.lit(RUNS), F.lit(0)).alias("words"))


def _places(phrase: str) -> Column:
    """Starts of a phrase among the words; looked for only where all its
    words occur."""
    parts = phrase.split()
    there = reduce(lambda a, b: a & b, (F.array_contains("words", p) for p in parts))
    starts = F.sequence(F.lit(0), F.size("words") - len(parts))
    same = lambda i: reduce(lambda a, b: a & b, (F.get("words", i + k) == p for k, p in enumerate(parts)))
    return F.when(there & (F.size("words") >= len(parts)), F.filter(starts, same)).otherwise(F.expr("cast(array() as array<int>)"))


def _matches(words: DataFrame, threshold: float, templates) -> DataFrame:
    """``digest, found, best``: labels and the highest containment of the
    texts that have a matching block."""
    sets, stride = template_sets(templates), stride_for(templates)
    vocabulary = sorted({w for _, s in sets for w in s})
    counted = words.select(F.explode(F.filter("words", lambda w: w.isin(vocabulary))).alias("w")).groupBy("w").count()
    # at most one row for each word of the templates
    often = {r["w"]: r["count"] for r in counted.collect()}
    order = sorted(vocabulary, key=lambda w: (often.get(w, 0), w))
    rank = {w: i for i, w in enumerate(order)}
    rows = []
    for i, (label, s) in enumerate(sets):
        s = sorted(s, key=rank.get)
        need = needed(len(s), threshold)
        rows += [(w, i, at, len(s), need, label, s) for at, w in enumerate(s[: len(s) - need + 1])]
    named = ("w", "template", "at", "n", "need", "label", "tokens")
    literal = [F.struct(*((_array(v) if isinstance(v, list) else F.lit(v)).alias(c) for c, v in zip(named, row, strict=True))) for row in rows]
    prefix = words.sparkSession.range(1).select(F.inline(F.array(*literal)))
    first_words = sorted({r[0] for r in rows})

    spots = words.where(F.arrays_overlap("words", _array(first_words))).select("digest", "words", F.posexplode("words").alias("pos", "w"))
    near = spots.where(F.col("w").isin(first_words)).join(F.broadcast(prefix), "w")
    last = F.floor(F.col("pos") / stride).cast("int")
    blocks = near.withColumn("block", F.explode(F.when(last > 0, F.array(last - 1, last)).otherwise(F.array(last))))
    block_words = F.slice("words", F.col("block") * stride + 1, F.lit(2 * stride))
    blocks = blocks.select("digest", "template", "label", "w", "at", "n", "need", "tokens", F.array_intersect(_array(order), block_words).alias("held"))
    left = F.least(F.col("n") - F.col("at"), F.size("held") - F.array_position("held", F.col("w")).cast("int") + 1)
    blocks = blocks.where((F.size("held") >= F.col("need")) & (left >= F.col("need")))
    blocks = blocks.withColumn("shared", F.size(F.array_intersect("tokens", "held"))).where("shared >= need")
    return blocks.groupBy("digest").agg(F.collect_set("label").alias("found"), F.max(F.col("shared") / F.col("n")).alias("best"))


def scan(docs: DataFrame, threshold: float = THRESHOLD, templates=TEMPLATES) -> DataFrame:
    """One row per document: ``n_words, n_base, first_word, last_word,
    base_labels, labels, score``."""
    words = _with_words(docs)
    named = [f"p{i}" for i in range(len(PHRASES))]
    base = words.select("doc_id", "digest", "words", *(_places(p).alias(c) for c, (p, _) in zip(named, PHRASES, strict=True)))
    every = F.concat(*named)
    labels = F.filter(
        F.array(*(F.when(F.size(c) > 0, F.lit(label)) for c, (_, label) in zip(named, PHRASES, strict=True))), lambda x: x.isNotNull()
    )
    base = base.select(
        "doc_id", "digest", F.size("words").cast("long").alias("n_words"), F.size(every).cast("long").alias("n_base"),
        F.array_min(every).cast("long").alias("first_word"), F.array_max(every).cast("long").alias("last_word"),
        F.array_sort(F.array_distinct(labels)).alias("own"),
    )
    found = base.join(_matches(words, threshold, templates), "digest", "left")
    none = F.expr("cast(array() as array<string>)")
    return found.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("own", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("own", F.coalesce("found", none))), ",").alias("labels"),
        F.greatest(F.coalesce("best", F.lit(0.0)), F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.lit(0.0))).alias("score"),
    )


def oracle(threshold: float = THRESHOLD, templates=TEMPLATES) -> str:
    """The same rows in DuckDB SQL, every block against every template."""
    stride = stride_for(templates)
    quoted = lambda items: "[" + ", ".join("'" + x + "'" for x in items) + "]"
    table = ",\n    ".join(f"('{label}', {quoted(s)}, {len(s)}, {needed(len(s), threshold)})" for label, s in template_sets(templates))
    phrases = ",\n    ".join(f"({quoted(p.split())}, '{label}')" for p, label in PHRASES)
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS row_no, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w
  FROM documents
), phrase(parts, label) AS (VALUES
    {phrases}
), template(label, tokens, n, need) AS (VALUES
    {table}
), places AS (
  SELECT row_no, p, label FROM d, phrase, unnest(range(0, len(w) - len(parts) + 1)) AS u(p)
  WHERE list_has_all(w, parts) AND list_slice(w, p + 1, p + len(parts)) = parts
), base AS (
  SELECT row_no, count(*) AS n_base, min(p) AS first_word, max(p) AS last_word, list(DISTINCT label) AS own FROM places GROUP BY row_no
), block AS (
  SELECT row_no, list_distinct(list_slice(w, {stride} * b + 1, {stride} * b + {2 * stride})) AS words
  FROM d, unnest(range(0, CAST(ceil(len(w) / {stride}.0) AS BIGINT))) AS u(b)
), hit AS (
  SELECT row_no, label, n, need, len(list_intersect(words, tokens)) AS shared FROM block, template
), method AS (
  SELECT row_no, list(DISTINCT label) AS found, max(CAST(shared AS DOUBLE) / n) AS best FROM hit WHERE shared >= need GROUP BY row_no
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  array_to_string(list_sort(coalesce(own, [])), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(own, []), coalesce(found, [])))), ',') AS labels,
  greatest(coalesce(best, 0.0::DOUBLE), CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS score
FROM d LEFT JOIN base USING (row_no) LEFT JOIN method USING (row_no)
"""

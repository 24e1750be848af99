"""URL filter by rules and a path-template tree.

Explicit rules (host suffix and path prefix, the longest wins) decide first.
The other pages are judged by a tree of path templates per host, built level
by level: segments that look variable (a digit in them) become wildcards, a
node with many small children is generalised, and labelled branches whose
blocked share isn't statistically different from their siblings' are merged.
A template is rejected if the smoothed share of blocked pages among its
labelled ones is high enough; the rules' verdicts are the labels.

The tree is built over distinct (host, shaped path) rows, not over pages, so
a host with a third of all pages is as many rows as it has distinct shapes.
Only DataFrame expressions are used.

Defined cases: a null url, or one without ``://``, has an empty host and an
empty path, fits no rule and belongs to the template of the empty path; a
template without labels is allowed; null ``page_id``s and repeated rows are
judged like any other; columns besides ``page_id`` and ``url`` are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwise.llm.common import LOWER, UPPER, Scratch, ascii_lower, spill

# fixed values: (verdict, host, path)
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: levels of the tree; deeper segments share the last level's template
LEVELS = 3
#: a child with less than 1/FANOUT of a node of more than FANOUT children is variable
FANOUT = 20
#: standard errors within which branches count as alike
ALIKE = 1.96
#: smoothed blocked share from which a template is rejected
REJECT = 0.8


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _by_length(rules):
    return sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))


def _first_rule(rules, value) -> Column:
    """The value of the longest rule that fits ``host`` and ``path``."""
    out = F.lit(None).cast("string")
    for rule in reversed(_by_length(rules)):
        _, host, path = rule
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        out = F.when(fits, F.lit(value(rule))).otherwise(out)
    return out


def _shaped(i: int) -> Column:
    """Segment i of the path ('' where there is none), wildcards for
    variable ones; an extension stays."""
    seg = F.coalesce(F.get("segments", F.lit(i)), F.lit(""))
    stem = F.regexp_replace(seg, r"\.[A-Za-z]+$", "")
    return F.when(stem.rlike("[0-9]"), F.concat(F.lit("*"), F.regexp_extract(seg, r"\.[A-Za-z]+$", 0))).otherwise(seg)


def _level(tree: DataFrame, level: int) -> DataFrame:
    """Replaces the segments of one level by their templates."""
    seg, up = f"s{level}", [f"t{i}" for i in range(level)]
    child = tree.groupBy("host", *up, seg).agg(F.sum("n").alias("n"), F.sum("m").alias("m"), F.sum("b").alias("b"))
    parent = child.groupBy("host", *up).agg(
        F.sum("n").alias("pn"), F.sum("m").alias("pm"), F.sum("b").alias("pb"),
        F.sum(F.when((F.col(seg) != "") & ~F.col(seg).startswith("*"), 1).otherwise(0)).alias("kids"),
    )
    r = (F.col("pb") + 1) / (F.col("pm") + 2)
    alike = F.abs(F.try_divide("b", "m") - F.try_divide("pb", "pm")) <= F.lit(ALIKE) * F.sqrt(F.try_divide(r * (1 - r), F.col("m")))
    name = (
        F.when((F.col(seg) == "") | F.col(seg).startswith("*"), F.col(seg))
        .when((F.col("kids") > FANOUT) & (F.col("n") * FANOUT < F.col("pn")), F.lit("*"))
        .when(F.coalesce((F.col("m") > 0) & alike, F.lit(False)), F.lit("*"))
        .otherwise(F.col(seg))
    )
    named = child.join(parent, ["host", *up]).select("host", *up, seg, name.alias(f"t{level}"))
    return tree.join(named, ["host", *up, seg])


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict, template, purity`` of each page;
    the last two are null where a rule decides."""
    url = F.col("url").cast("string")
    read = pages.select(F.col("page_id").cast("long").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    read = read.withColumn("rule", _first_rule(rules, lambda r: r[1] + r[2])).withColumn("ruled", _first_rule(rules, lambda r: r[0]))
    read = read.withColumn("segments", F.filter(F.split("path", "/"), lambda s: s != ""))
    shape = [f"s{i}" for i in range(LEVELS)]
    read = read.select("page_id", "host", "path", "rule", "ruled", *(_shaped(i).alias(s) for i, s in enumerate(shape)))

    tree = read.groupBy("host", *shape).agg(
        F.count("*").alias("n"), F.count("ruled").alias("m"), F.sum(F.when(F.col("ruled") == "block", 1).otherwise(0)).alias("b")
    )
    names = [f"t{i}" for i in range(LEVELS)]
    with Scratch(pages.sparkSession, "paths") as scratch:
        tree = scratch.spill(tree)
        for level in range(LEVELS):
            tree = _level(tree, level)
        purity = tree.groupBy("host", *names).agg(((F.sum("b") + 1) / (F.sum("m") + 2)).alias("purity"))
        template = F.concat("host", *(F.when(F.col(t) != "", F.concat(F.lit("/"), F.col(t))).otherwise(F.lit("")) for t in names))
        judged = spill(tree.join(purity, ["host", *names]).select("host", *shape, template.alias("template"), "purity"), "templates")

    # pages that a rule decides need no template; the others are joined
    free = read.where("ruled is null").join(judged, ["host", *shape])
    free = free.select("page_id", "host", "path", "rule", F.when(F.col("purity") >= REJECT, F.lit("block")).otherwise(F.lit("allow")).alias("verdict"), "template", "purity")
    ruled = read.where("ruled is not null").select(
        "page_id", "host", "path", "rule", F.col("ruled").alias("verdict"), F.lit(None).cast("string").alias("template"), F.lit(None).cast("double").alias("purity")
    )
    return ruled.union(free)


def oracle(rules=RULES) -> str:
    """The same rows in DuckDB SQL."""
    fits = [f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')" for _, h, p in _by_length(rules)]
    rule = " ".join(f"WHEN {f} THEN '{h}{p}'" for f, (_, h, p) in zip(fits, _by_length(rules), strict=True))
    ruled = " ".join(f"WHEN {f} THEN '{v}'" for f, (v, _, _) in zip(fits, _by_length(rules), strict=True))
    shape = ", ".join(f"s{i}" for i in range(LEVELS))
    shaped = ",\n    ".join(
        f"CASE WHEN regexp_matches(regexp_replace(coalesce(seg[{i + 1}], ''), '\\.[A-Za-z]+$', ''), '[0-9]') "
        f"THEN '*' || regexp_extract(coalesce(seg[{i + 1}], ''), '\\.[A-Za-z]+$') ELSE coalesce(seg[{i + 1}], '') END AS s{i}"
        for i in range(LEVELS)
    )
    steps = []
    for i in range(LEVELS):
        up = "".join(f", t{j}" for j in range(i))
        before = f"tree{i - 1}" if i else "shape"
        steps.append(f"""child{i} AS (
  SELECT host{up}, s{i}, sum(n) AS n, sum(m) AS m, sum(b) AS b FROM {before} GROUP BY ALL
), named{i} AS (
  SELECT host{up}, s{i}, CASE WHEN s{i} = '' OR starts_with(s{i}, '*') THEN s{i}
    WHEN sum(CASE WHEN s{i} <> '' AND NOT starts_with(s{i}, '*') THEN 1 ELSE 0 END) OVER p > {FANOUT} AND n * {FANOUT} < sum(n) OVER p THEN '*'
    WHEN m > 0 AND abs(b::DOUBLE / m - (sum(b) OVER p)::DOUBLE / (sum(m) OVER p)) <= {ALIKE}::DOUBLE * sqrt(
      (((sum(b) OVER p) + 1)::DOUBLE / ((sum(m) OVER p) + 2)) * (1 - ((sum(b) OVER p) + 1)::DOUBLE / ((sum(m) OVER p) + 2)) / m) THEN '*'
    ELSE s{i} END AS t{i}
  FROM child{i} WINDOW p AS (PARTITION BY host{up})
), tree{i} AS (
  SELECT * FROM {before} JOIN named{i} USING (host{up}, s{i})
)""")
    names = ", ".join(f"t{i}" for i in range(LEVELS))
    template = " || ".join(["host", *(f"CASE WHEN t{i} <> '' THEN '/' || t{i} ELSE '' END" for i in range(LEVELS))])
    return f"""
WITH parsed AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages
), ruled AS (
  SELECT *, CASE {rule} END AS rule, CASE {ruled} END AS ruled, list_filter(string_split(path, '/'), lambda x: x <> '') AS seg FROM parsed
), page AS (
  SELECT page_id, host, path, rule, ruled,
    {shaped}
  FROM ruled
), shape AS (
  SELECT host, {shape}, count(*) AS n, count(ruled) AS m, sum(CASE WHEN ruled = 'block' THEN 1 ELSE 0 END) AS b FROM page GROUP BY ALL
), {", ".join(steps)}, scored AS (
  SELECT host, {names}, (sum(b) + 1)::DOUBLE / (sum(m) + 2) AS purity FROM tree{LEVELS - 1} GROUP BY ALL
), judged AS (
  SELECT host, {shape}, {template} AS template, purity FROM tree{LEVELS - 1} JOIN scored USING (host, {names})
)
SELECT page_id, page.host AS host, path, rule,
  coalesce(ruled, CASE WHEN judged.purity >= {REJECT}::DOUBLE THEN 'block' ELSE 'allow' END) AS verdict,
  CASE WHEN ruled IS NULL THEN judged.template END AS template, CASE WHEN ruled IS NULL THEN judged.purity END AS purity
FROM page JOIN judged USING (host, {shape})
"""

"""URL filter: rules by host and path, and path templates rejected by the verdicts known inside them."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.joins import join_back
from plumbline.llm.shared import checkpointed

LEVELS = 6
MIN_SUPPORT = 3
MAX_LITERALS = 20
REJECT_AT = 0.9
SIMILAR = math.sqrt(0.5 * math.log(2 / 0.5))  # Hoeffding bound at one half
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SHARES = ("blocked", "allowed", "ends", "digits")

Rule = tuple[str, str]  # verdict ("allow" or "block") and host with path, such as ("block", "example.com/de/")


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, PARTS, 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def longest_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """(verdict, rule) of the longest rule that fits; block goes before allow, then the rules' order."""
    fits = []
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[0] != "block")):
        if verdict not in ("allow", "block"):
            raise ValueError(f"neither allow nor block: {verdict}")
        cut = rule.find("/") if "/" in rule else len(rule)
        own, start = rule[:cut].translate(str.maketrans(UPPER, LOWER)), rule[cut:]
        here = ((host == own) | F.endswith(host, F.lit(f".{own}"))) & F.startswith(path, F.lit(start))
        fits.append(F.when(here, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))))
    return F.coalesce(*fits) if fits else F.lit(None).cast("struct<verdict:string,rule:string>")


def segments(path: Column) -> Column:
    """The path between its slashes; what follows LEVELS segments is one segment more."""
    return F.when(path == "", F.array().cast("array<string>")).otherwise(F.split(F.substr(path, F.lit(2)), "/", LEVELS + 1))


def literal(segment: Column) -> Column:
    """A segment in which no sign of a template stands for itself."""
    return reduce(lambda s, c: F.replace(s, F.lit(c), F.lit(f"%{ord(c):02X}")), "*{|}", segment)


def branches(live: DataFrame, level: int) -> DataFrame:
    """(host, node, seg, rows, token) of the segments that stay literal under a node of the tree.

    A segment stays if MIN_SUPPORT paths and one in MAX_LITERALS of the node's
    have it; so a node has MAX_LITERALS branches at most beside its wildcard.
    Branches are ordered by their shares of blocked, allowed and ending paths
    and of those that go on with a digit; neighbours whose shares differ by no
    more than the Hoeffding bound are one branch.
    """
    children = checkpointed(live.groupBy("host", "node", "seg").agg(
        F.count("*").alias("n"), F.sum("blocked").alias("blocked"), F.sum("allowed").alias("allowed"),
        F.sum((F.size("segs") == level + 1).cast("long")).alias("ends"),
        F.sum(F.coalesce(F.get("segs", F.lit(level + 1)).rlike("^[0-9]"), F.lit(False)).cast("long")).alias("digits"),
    ))
    nodes = checkpointed(children.groupBy("host", "node").agg(F.sum("n").alias("total"), F.count("*").alias("n_children")))
    n_children = nodes.agg(F.sum("n_children")).first()[0] or 0
    often = children.where(F.col("n") >= MIN_SUPPORT)
    sized = join_back(often, nodes, ["host", "node"], ["total"], F.col("n_children"), n_children, F.col("seg"))
    kept = sized.where(F.col("n") * MAX_LITERALS >= F.col("total"))
    order = Window.partitionBy("host", "node").orderBy(*[F.col(c) / F.col("n") for c in SHARES], "seg")
    before = {c: F.lag(c).over(order) for c in ("n", *SHARES)}
    near = SIMILAR * (1 / F.sqrt("n") + 1 / F.sqrt(before["n"]))
    same = reduce(lambda a, b: a & b, [F.abs(F.col(c) / F.col("n") - before[c] / before["n"]) <= near for c in SHARES])
    grouped = kept.withColumn("apart", F.coalesce(~same, F.lit(True)).cast("int")).withColumn("branch", F.sum("apart").over(order))
    whole = Window.partitionBy("host", "node", "branch")
    names = F.sort_array(F.collect_list(literal(F.col("seg"))).over(whole))
    token = F.when(F.size(names) == 1, F.get(names, F.lit(0))).otherwise(F.concat(F.lit("{"), F.array_join(names, "|"), F.lit("}")))
    return grouped.select("host", "node", "seg", F.col("n").alias("rows"), token.alias("token"))


def path_templates(paths: DataFrame) -> DataFrame:
    """``node``, the template, for distinct paths (host, path, blocked, allowed): the tree of every host level by level."""
    live = checkpointed(paths.select("*", segments(F.col("path")).alias("segs"), F.lit("").alias("node")))
    done = []
    for level in range(LEVELS + 1):
        done.append(live.where(F.size("segs") == level).drop("segs"))
        live = live.where(F.size("segs") > level).withColumn("seg", F.get("segs", F.lit(level)))
        count = live.count()
        if not count:
            break
        tree = checkpointed(branches(live, level))
        found = join_back(live, tree, ["host", "node", "seg"], ["token"], F.col("rows"), count, F.col("path"))
        live = checkpointed(found.withColumn("node", F.concat("node", F.lit("/"), F.coalesce("token", F.lit("*")))).drop("seg", "token"))
    else:
        done.append(live.drop("segs"))
    return reduce(DataFrame.unionByName, done)


def judge_urls(
    pages: DataFrame, rules: Sequence[Rule], keep: list[str] | None = None, url_col: str = "url", label_col: str | None = None,
) -> DataFrame:
    """allow or block for every URL: by the longest rule that fits, else by its host's path template.

    The paths of a host form a tree. Segments with few paths become wildcards,
    statistically similar branches become one. A path is known as blocked or
    allowed if most of its rows are, by their rule or else by ``label_col``
    ("allow", "block" or null). A template is rejected if the smoothed share
    (blocked + 1) / (blocked + allowed + 2) of its known paths reaches
    REJECT_AT: eight blocked paths against none at least, so nothing is
    rejected without evidence. Levels beyond LEVELS are one segment.

    Returns ``keep`` (all columns by default), ``host``, ``path``, ``rule``,
    ``template``, ``purity`` and ``verdict``. A URL that is null or has no
    ``://`` has an empty host and path. Repeated rows get equal results. Columns
    named like a result are replaced.
    """
    own = ("host", "path", "rule", "template", "purity", "verdict")
    keep = [c for c in (pages.columns if keep is None else keep) if c not in own]
    url = F.col(f"`{url_col}`")
    label = F.lit(None).cast("string") if label_col is None else F.col(f"`{label_col}`")
    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), host_of(url).alias("host"), path_of(url).alias("path"), label.alias("label"))
    rows = rows.withColumn("ruled", longest_rule(F.col("host"), F.col("path"), rules))
    known = F.coalesce("ruled.verdict", "label")
    tally = rows.groupBy("host", "path").agg(
        F.count("*").alias("rows"), F.count(F.when(known == "block", 1)).alias("b"), F.count(F.when(known == "allow", 1)).alias("a")
    )
    paths = tally.select("host", "path", "rows", (F.col("b") > F.col("a")).cast("long").alias("blocked"), (F.col("a") > F.col("b")).cast("long").alias("allowed"))
    placed = checkpointed(path_templates(paths))
    templates = checkpointed(placed.groupBy("host", "node").agg(
        F.count("*").alias("n"), ((F.sum("blocked") + 1) / (F.sum("blocked") + F.sum("allowed") + 2)).alias("purity")
    ))
    sizes = placed.agg(F.count("*").alias("paths"), F.sum("rows").alias("rows")).first()
    judged = checkpointed(join_back(placed, templates, ["host", "node"], ["purity"], F.col("n"), sizes["paths"], F.col("path")))
    values = judged.select("host", "path", "rows", F.col("node").alias("template"), "purity")
    spread = F.struct("row", "host", "path") if keep else F.col("path")
    found = join_back(rows, values, ["host", "path"], ["template", "purity"], F.col("rows"), sizes["rows"] or 0, spread)
    verdict = F.coalesce("ruled.verdict", F.when(F.col("purity") >= REJECT_AT, "block").otherwise("allow"))
    return found.select(*[F.col(f"row.`{c}`").alias(c) for c in keep], "host", "path", F.col("ruled.rule").alias("rule"), "template", "purity", verdict.alias("verdict"))


def judge_sql(rules: Sequence[Rule]) -> str:
    """The same in SQL over ``pages``, one group of tables a level."""
    ordered = sorted(rules, key=lambda r: (-len(r[1]), r[0] != "block"))
    fits = {r: f"((host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '/{p}'))" for r in ordered for h, _, p in (r[1].partition("/"),)}
    when = lambda i: " ".join(f"WHEN {fits[r]} THEN '{r[i]}'" for r in ordered)
    steps = [f"""
parsed AS (SELECT page_id, coalesce(translate(regexp_extract(url, '{PARTS}', 1), '{UPPER}', '{LOWER}'), '') AS host,
  coalesce(regexp_extract(url, '{PARTS}', 2), '') AS path FROM pages),
ruled AS (SELECT *, CASE {when(1)} END AS rule, CASE {when(0)} END AS given FROM parsed),
tally AS (SELECT host, path, count(*) FILTER (given = 'block') AS b, count(*) FILTER (given = 'allow') AS a FROM ruled GROUP BY ALL),
cut AS (SELECT *, (b > a)::BIGINT AS blocked, (a > b)::BIGINT AS allowed,
  CASE WHEN path = '' THEN []::VARCHAR[] ELSE string_split(substr(path, 2), '/') END AS s FROM tally),
level0 AS (SELECT host, path, blocked, allowed, '' AS node,
  CASE WHEN len(s) > {LEVELS} THEN list_append(s[1:{LEVELS}], array_to_string(s[{LEVELS + 1}:], '/')) ELSE s END AS segs FROM cut)"""]
    for k in range(LEVELS + 1):
        shares = ", ".join(f"{c} / n" for c in SHARES)
        same = " AND ".join(f"abs({c} / n - lag({c}) OVER o / lag(n) OVER o) <= {SIMILAR!r}::DOUBLE * (1 / sqrt(n) + 1 / sqrt(lag(n) OVER o))" for c in SHARES)
        clean = "seg"
        for c in "*{|}":
            clean = f"replace({clean}, '{c}', '%{ord(c):02X}')"
        steps.append(f"""
children{k} AS (SELECT host, node, segs[{k + 1}] AS seg, count(*) AS n, sum(blocked) AS blocked, sum(allowed) AS allowed,
  count(*) FILTER (len(segs) = {k + 1}) AS ends, count(*) FILTER (regexp_matches(segs[{k + 2}], '^[0-9]')) AS digits
  FROM level{k} WHERE len(segs) > {k} GROUP BY ALL),
kept{k} AS (SELECT * FROM (SELECT *, sum(n) OVER (PARTITION BY host, node) AS total FROM children{k})
  WHERE n >= {MIN_SUPPORT} AND n * {MAX_LITERALS} >= total),
marked{k} AS (SELECT *, CASE WHEN coalesce({same}, false) THEN 0 ELSE 1 END AS apart FROM kept{k}
  WINDOW o AS (PARTITION BY host, node ORDER BY {shares}, seg)),
branch{k} AS (SELECT *, sum(apart) OVER (PARTITION BY host, node ORDER BY {shares}, seg) AS branch FROM marked{k}),
token{k} AS (SELECT host, node, branch, CASE WHEN count(*) = 1 THEN min({clean})
  ELSE '{{' || string_agg({clean}, '|' ORDER BY {clean}) || '}}' END AS token FROM branch{k} GROUP BY ALL),
level{k + 1} AS (SELECT l.host, path, l.blocked, l.allowed, segs,
  l.node || CASE WHEN len(segs) > {k} THEN '/' || coalesce(token, '*') ELSE '' END AS node
  FROM level{k} l LEFT JOIN (SELECT host, node, seg, token FROM branch{k} JOIN token{k} USING (host, node, branch)) t
  ON l.host = t.host AND l.node = t.node AND segs[{k + 1}] = t.seg)""")
    return f"WITH {','.join(steps)}," + f"""
purities AS (SELECT host, node, (sum(blocked) + 1) / (sum(blocked) + sum(allowed) + 2) AS purity FROM level{LEVELS + 1} GROUP BY ALL)
SELECT page_id, host, path, rule, node AS template, purity,
  coalesce(given, CASE WHEN purity >= {REJECT_AT} THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled JOIN level{LEVELS + 1} l USING (host, path) JOIN purities USING (host, node)
"""

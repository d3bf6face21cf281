"""URL filters: host and path rules first, then a path-template tree per host.

Below each host the path's segments are walked level by level, to the last one
of the longest path; a path that is alone in its node ends there, as all its
further labels are `~`. Each child is compared with its siblings: one that
repeats and whose labelled share of bad pages differs from its siblings'
(two-proportion z-test) keeps its name, however many siblings it has. Where
children are many, those that seldom repeat are generalised into `*`; where they
are few, one that differs keeps its name too. The rest merge into `~`.
A template (host and labels
of the walk) is rejected when its smoothed labelled purity, (bad + a * prior) /
(labelled + a) with the prior over all labelled pages, reaches the threshold.

All counts are aggregates over distinct (host, path) rows with map-side combine
and every walk step joins on (host, node, segment), so a hot host spreads over
its segments; the only rows that a host shares are its nodes.

Defined results: a null url, or one without "://", has empty host and path and
no rule; null labels count for the tree's shape only; without any labelled page
nothing is rejected; repeated rows each get the verdict; an empty table gives an empty table.
"""

from __future__ import annotations

import string
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop_table, materialize
from .quality_rules import Counts

#: (verdict, host, path)
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))


@dataclass(frozen=True)
class TreeOptions:
    min_children: int = 8  # fewer are never generalised
    max_repeats: float = 4.0  # rows of a child at most for a variable segment
    z: float = 2.58
    smoothing: float = 10.0
    threshold: float = 0.5


def split_url(df: DataFrame, url: str) -> DataFrame:
    """df with host and path by the contract: host up to / ? or #, A-Z lower-cased; path up to ? or #."""
    u = F.coalesce(F.col(url), F.lit(""))
    at = F.instr(u, "://")
    rest = F.when(at > 0, u.substr(at + 3, F.length(u))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    return df.withColumn("host", host).withColumn("path", F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, or null. The rule list is a parameter, so its size is that of the call."""
    found = None
    for verdict, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        value = F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, value) if found is None else found.when(fits, value)
    return found


def templates(pages: DataFrame, options: TreeOptions = TreeOptions()) -> DataFrame:
    """pages (host, path, bad: boolean or null) -> one row per (host, path) with its template, the template's purity and whether it is rejected."""
    o = options
    paths = pages.groupBy("host", "path").agg(F.count("*").alias("n"), F.count("bad").alias("labelled"), F.count_if("bad").alias("bad"))
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    paths = paths.select("host", "path", "n", "labelled", "bad", segments.alias("segs"), F.lit("").alias("node")).withColumn("open", F.size("segs") > 0)
    # A table for each level, of the paths that reach it.
    levels, depth = [materialize(paths, "url-paths")], 0
    while (here := levels[-1].filter("open")).take(1):
        here = here.withColumn("seg", F.get("segs", F.lit(depth)))
        children = here.groupBy("host", "node", "seg").agg(F.count("*").alias("paths"), F.sum("n").alias("n"), F.sum("labelled").alias("m"), F.sum("bad").alias("b"))
        nodes = children.groupBy("host", "node").agg(F.count("*").alias("kids"), F.sum("paths").alias("all_paths"), F.sum("m").alias("all_m"), F.sum("b").alias("all_b"))
        joined = children.join(nodes, ["host", "node"])
        variable = (F.col("kids") >= o.min_children) & (F.col("n") <= o.max_repeats)
        m1, m2 = F.col("m"), F.col("all_m") - F.col("m")
        pooled = F.try_divide(F.col("all_b"), F.col("all_m"))
        error = F.sqrt(pooled * (1 - pooled) * (F.try_divide(F.lit(1.0), m1) + F.try_divide(F.lit(1.0), m2)))
        gap = F.abs(F.try_divide(F.col("b"), m1) - F.try_divide(F.col("all_b") - F.col("b"), m2))
        differs = F.coalesce(gap > o.z * error, F.lit(False))
        label = F.when(variable, F.lit("*")).when(differs, F.col("seg")).otherwise(F.lit("~"))
        labels = joined.select(F.col("host").alias("h"), F.col("node").alias("nd"), F.col("seg").alias("sg"), label.alias("label"), (F.col("all_paths") == 1).alias("alone"))
        match = (F.col("host") == F.col("h")) & (F.col("node") == F.col("nd")) & (F.col("seg") == F.col("sg"))
        left = F.size("segs") - depth
        alone = F.col("alone") & F.lit(o.min_children > 1)
        walked = here.join(labels, match).select("host", "path", "n", "labelled", "bad", "segs", F.when(alone, F.concat("node", F.repeat(F.lit("/~"), left))).otherwise(F.concat("node", F.lit("/"), "label")).alias("node"), (~alone & (left > 1)).alias("open"))
        levels.append(materialize(walked, "url-paths"))
        depth += 1
    ended = reduce(DataFrame.unionByName, [x.filter("not open").select("host", "path", "labelled", "bad", "node") for x in levels])
    state = materialize(ended, "url-templates")
    for x in levels:
        drop_table(x)
    total = state.agg(F.sum("bad").alias("b"), F.sum("labelled").alias("m")).select(F.coalesce(F.try_divide("b", "m"), F.lit(0.0)).alias("prior"))
    prior = total.first()["prior"]
    purity = (F.col("b") + o.smoothing * prior) / (F.col("m") + o.smoothing)
    scored = state.groupBy("host", "node").agg(F.sum("bad").alias("b"), F.sum("labelled").alias("m")).select(F.col("host").alias("h"), F.col("node").alias("nd"), purity.alias("purity"))
    out = state.join(scored, (F.col("host") == F.col("h")) & (F.col("node") == F.col("nd")))
    return out.select("host", "path", F.concat("host", "node").alias("template"), "purity", (F.col("purity") >= o.threshold).alias("rejected"))


def junk_page(html: Column) -> Column:
    """A page's label where none is given: symbols are more than a twentieth of its text outside tags. Null for pages without text."""
    text = F.regexp_replace(html, "<[^>]*>", " ")
    c = Counts(text)
    return F.when(c.word_chars() > 0, c.n_symbols() * 20 > c.word_chars())


#: Words of a host that label its pages as bad where no labels are given. Fixed values.
LISTED = ("casino", "bets", "pills", "adult", "viagra", "porn", "poker")


def listed_page(url: Column) -> Column:
    """Whether a word of LISTED stands in the url's host."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"://([^/?#]*)", 1)).rlike(rf"(^|[.\-])({'|'.join(LISTED)})([.\-]|$)"), F.lit(False))


def judge(df: DataFrame, page_id: str = "page_id", url: str = "url", bad: Column | None = None, rules=RULES, options: TreeOptions = TreeOptions()) -> DataFrame:
    """page_id, host, path, rule, verdict and the template and purity that a page without a rule is judged by. `bad`: the label column, boolean or null."""
    labelled = F.lit(None).cast("boolean") if bad is None else bad.cast("boolean")
    slim = split_url(df.select(F.col(page_id).alias("page_id"), F.col(url).alias("__url"), labelled.alias("bad")), "__url").drop("__url")
    slim = materialize(slim, "urls")
    t = templates(slim, options).withColumnsRenamed({"host": "h", "path": "p"})
    fit = rule_of(F.col("host"), F.col("path"), rules)
    out = slim.withColumn("fit", fit).join(t, (F.col("host") == F.col("h")) & (F.col("path") == F.col("p")), "left")
    own = F.when(F.col("rejected"), F.lit("block")).otherwise(F.lit("allow"))
    return out.select("page_id", "host", "path", F.col("fit.rule").alias("rule"), F.coalesce(F.col("fit.verdict"), own).alias("verdict"), "template", "purity")

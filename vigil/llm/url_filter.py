"""URL filters by host and path rules and by a tree of path templates, built-in functions
only.

A rule (allow or block, host, path) fits its host and all subdomains if the path starts
with the rule's; the longest rule wins. The other URLs are judged by templates: per host,
segments with digits are generalised; a node of the tree with many children that hardly
repeat has its children replaced by a wildcard; sibling branches that differ in one
literal segment only are merged when their labelled purities do not differ significantly,
and unlabelled ones join them when they hold about as many pages; a template is rejected
when its purity, smoothed towards its host's, reaches the threshold. Labels are the rules'
verdicts, or a column of the caller's.

All work is on distinct (host, shape) rows after one aggregation of the pages; hot hosts
and shapes are combined map-side or split as heavy keys.

Defined results
* host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased;
  path: from there up to ``?``, ``#`` or the end; a null url or one without ``://`` has
  both empty and is judged like any other
* ties among equally long rules go to the one that comes first in the alphabet
* empty segments do not count; segments from level LEVELS on are one segment together
* a template that neither has labels nor joins branches with labels is allowed; every row gives a row, repeated rows too; an empty
  table gives none; other columns are not read
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import ascii_lower, fixed, join_counted

#: levels of the tree; all segments from the last level on are one
LEVELS = 8
#: a node is variable with so many children of which more than half occur once
LEAST_CHILDREN = 20
#: labelled pages that every template is taken to have had, as clean as its host (and every
#: host, all clean)
CLEAN_PAGES = 2
THRESHOLD = 0.5


@dataclass(frozen=True)
class Rule:
    allow: bool
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(url, "://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1)


def _fits(rule: Rule, host: Column, path: Column) -> Column:
    return (((host == rule.host) | F.endswith(host, F.lit("." + rule.host)))
            & F.startswith(path, F.lit(rule.path)))


def longest_rule(rules: list[Rule], host: Column, path: Column, out: str) -> Column:
    """Text (``out`` "rule") or verdict (``out`` "verdict") of the longest rule that fits."""
    found = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (-len(r.text), r.text), reverse=True):
        value = r.text if out == "rule" else "allow" if r.allow else "block"
        found = F.when(_fits(r, host, path), F.lit(value)).otherwise(found)
    return found


def levels_of(path: Column) -> Column:
    segments = F.transform(F.filter(F.split(path, "/", -1), lambda s: s != ""),
                           lambda s: F.regexp_replace(s, "[0-9]+", "{n}"))
    rest = F.array_join(F.slice(segments, LEVELS, F.greatest(F.size(segments), F.lit(1))), "/")
    return (F.when(F.size(segments) <= LEVELS, segments)
            .otherwise(F.concat(F.slice(segments, 1, LEVELS - 1), F.array(rest))))


def _templates(shapes: DataFrame) -> DataFrame:
    """shapes with ``template``: wildcards for the children of variable nodes."""
    nodes = shapes.select("shape", "n", F.posexplode("shape.levels").alias("depth", "segment"))
    nodes = fixed(nodes.select("shape", "n", "depth", "segment", F.struct(
        "shape.host", "depth", F.array_join(F.slice("shape.levels", F.lit(1), F.col("depth")), "/")
        .alias("above")).alias("node")))
    children = nodes.groupBy("node", "segment").agg(F.sum("n").alias("n"),
                                                    F.count(F.lit(1)).alias("n_shapes"))
    variable = fixed(children.groupBy("node")
                     .agg(F.count(F.lit(1)).alias("n_children"), F.sum("n").alias("n_pages"),
                          F.sum("n_shapes").alias("n_shapes"))
                     .filter((F.col("n_children") >= LEAST_CHILDREN)
                             & (2 * F.col("n_children") > F.col("n_pages"))))
    wild = (join_counted(nodes.select("shape", "depth", "node"), variable, "node", "n_shapes")
            .groupBy("shape").agg(F.collect_set("depth").alias("wild")))
    both = shapes.join(wild, "shape", "left")
    return both.withColumn("template", F.transform(
        "shape.levels", lambda s, i: F.when(F.array_contains("wild", i), "*").otherwise(s)))


def _merged(templates: DataFrame) -> DataFrame:
    """host, template, bad, labelled, evidence of the templates that are judged by labels.

    A template's family are the branches beside it that differ in its last literal segment
    only. Labelled branches whose purity does not differ significantly from the family's pool
    their labels ("branch" evidence; the others keep their own). An unlabelled branch whose
    number of pages does not differ significantly from the pooled branches' mean (both
    taken as Poisson counts) is judged by the pool ("family" evidence)."""
    literal = F.transform("template", lambda s, i: F.when(
        (s == "*") | F.contains(s, F.lit("{n}")), -1).otherwise(i))
    last = F.coalesce(F.array_max(literal), F.lit(-1))
    placed = templates.withColumn("last", last).withColumn("family", F.struct(
        "host", F.array_join(F.transform("template", lambda s, i: F.when(
            i == F.col("last"), "?").otherwise(s)), "/").alias("mask")))
    placed = fixed(placed.drop("last"))
    pool = fixed(placed.groupBy("family").agg(
        F.sum("bad").alias("all_bad"), F.sum("labelled").alias("all_labelled"),
        F.count(F.lit(1)).alias("n_branches")).filter("all_labelled > 0"))
    k, n = F.col("all_bad").cast("double"), F.col("all_labelled").cast("double")
    gap = F.col("bad") * n - F.col("labelled") * k
    near = fixed(join_counted(placed, pool, "family", "n_branches")
                 .withColumn("similar", (F.col("labelled") > 0)
                             & (gap * gap <= 4 * F.col("labelled") * k * (n - k)))
                 .select("family", "host", "template", "bad", "labelled", "n", "similar"))
    sums = near.groupBy("family").agg(
        F.sum(F.when(F.col("similar"), F.col("bad"))).alias("sum_bad"),
        F.sum(F.when(F.col("similar"), F.col("labelled"))).alias("sum_labelled"),
        F.sum(F.when(F.col("similar"), F.col("n"))).alias("sum_n"),
        F.count_if("similar").alias("n_similar"), F.count(F.lit(1)).alias("n_branches"))
    both = join_counted(near, fixed(sums), "family", "n_branches")
    own, pooled = F.col("n") * F.col("n_similar"), F.col("sum_n")
    alike = ((F.col("labelled") == 0) & (F.col("n_similar") > 0)
             & ((own - pooled) * (own - pooled) <= 4 * F.col("n_similar") * (own + pooled)))
    use_pool = F.col("similar") | alike
    return both.filter((F.col("labelled") > 0) | alike).select(
        "host", "template", F.when(use_pool, F.col("sum_bad")).otherwise(F.col("bad")).alias("bad"),
        F.when(use_pool, F.col("sum_labelled")).otherwise(F.col("labelled")).alias("labelled"),
        F.when(F.col("labelled") > 0, "branch").otherwise("family").alias("evidence"))


def _judged(templates: DataFrame) -> DataFrame:
    """host, template, rejected, evidence: purity smoothed towards the host's, where pages
    without a label count as clean."""
    hosts = fixed(templates.groupBy("host").agg(
        (F.sum("bad") / (F.sum("n") + CLEAN_PAGES)).alias("prior"),
        F.count(F.lit(1)).alias("n_templates")))
    found = join_counted(fixed(_merged(templates)), hosts, "host", "n_templates")
    purity = (F.col("bad") + CLEAN_PAGES * F.col("prior")) / (F.col("labelled") + CLEAN_PAGES)
    return found.select("host", "template", (purity >= THRESHOLD).alias("rejected"), "evidence")


def judge(pages: DataFrame, rules: list[Rule], bad: Column | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict, template and evidence (rule, branch, family or
    none) of every row of ``pages``. ``bad`` is a boolean column of ``pages`` with the labels (null: none); without it the rules label."""
    url = F.coalesce(pages["url"], F.lit(""))
    rows = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"),
                        (F.lit(None).cast("boolean") if bad is None else bad).alias("bad"))
    by_rule = longest_rule(rules, F.col("host"), F.col("path"), "verdict")
    rows = rows.select(
        "page_id", "host", "path", longest_rule(rules, F.col("host"), F.col("path"), "rule")
        .alias("rule"), by_rule.alias("by_rule"),
        (by_rule == "block" if bad is None else F.col("bad")).alias("bad"),
        F.struct("host", levels_of(F.col("path")).alias("levels")).alias("shape"))
    shapes = fixed(rows.groupBy("shape").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("bad").alias("bad"),
        F.count("bad").alias("labelled")))
    named = fixed(_templates(shapes).select("shape", "n", "bad", "labelled", "template"))
    templates = named.groupBy(F.col("shape.host").alias("host"), "template").agg(
        F.sum("bad").alias("bad"), F.sum("labelled").alias("labelled"), F.sum("n").alias("n"))
    templates = fixed(templates)
    judged = (named.withColumn("host", F.col("shape.host"))
              .join(_judged(templates), ["host", "template"], "left")
              .select("shape", "n", "rejected", "evidence",
                      F.array_join("template", "/").alias("template")))
    out = join_counted(rows, fixed(judged), "shape", "n")
    return out.select("page_id", "host", "path", "rule", F.coalesce(
        "by_rule", F.when(F.col("rejected"), "block").otherwise("allow")).alias("verdict"),
        "template", F.when(F.col("by_rule").isNotNull(), "rule")
        .otherwise(F.coalesce("evidence", F.lit("none"))).alias("evidence"))

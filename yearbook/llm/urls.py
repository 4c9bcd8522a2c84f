"""URL filters: rules by host and path, and a path-template tree for what no rule covers.

A path's *shape* has every run of digits as ``#``. Each host has a tree of its shapes'
segments. Level by level, a node's children become the wildcard ``?`` in two cases:

* many and rare: the node has over ``FANOUT`` children, and the child has less than
  ``1 / FANOUT`` of the node's URLs;
* alike: Hoeffding bounds tell neither the labels nor the share of paths that end at the
  child from those of its siblings. That takes labels on both sides.

What a path becomes is its *template*. A template is rejected by its labelled purity: the
share of blocked URLs among its labelled ones, smoothed towards the share that its shapes
have on all hosts, which is itself smoothed towards the share of the whole table. ``#``
and ``?`` end a path, so no segment can hold them.

DataFrame operations only. Everything after the first count works on distinct (host, shape)
pairs. Sums that belong beside many rows are joined through salted keys (``attach``), so
a host, a segment or a template may hold any share of the rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yearbook.llm.tables import attach, written

#: Levels of a tree; the last one takes the rest of a path as one segment.
DEPTH = 8
#: Literal children of a node: all up to this many, else those with a share over one of it.
FANOUT = 16
#: The factor of Hoeffding's bound at five in a hundred: sqrt(ln(2 / 0.05) / 2).
BOUND = 1.3581
#: Pseudo-URLs of each smoothing, and the smoothed purity from which a template is blocked.
WEIGHT, REJECT = 2.0, 0.75
#: A template with more than one in so many URLs is joined by broadcast: at most as many rows.
HOT = 512


class Rule(NamedTuple):
    """``verdict`` (allow or block) for a host, its subdomains, and paths that start so."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; then up to ``?``, ``#`` or the end. Null or no ``://``: both empty."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.coalesce(F.translate(host, upper, lower), F.lit("")), F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting(rules: Sequence[Rule], host: Column, path: Column, pick: str) -> Column:
    """``pick`` (a field) of the longest rule that fits, null if none does; of two as long
    the one with the longer host."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), len(r.host), r.name)):
        fits = (host == rule.host) | F.endswith(host, F.lit("." + rule.host))
        found = F.when(fits & F.startswith(path, F.lit(rule.path)), F.lit(getattr(rule, pick))).otherwise(found)
    return found


def _differ(a: str, of_a: str, b: str, of_b: str) -> Column:
    """Whether the shares a / of_a and b / of_b are further apart than chance explains."""
    na, nb = (F.greatest(F.col(c), F.lit(1)) for c in (of_a, of_b))
    return F.abs(F.col(a) / na - F.col(b) / nb) > BOUND * (1 / F.sqrt(na) + 1 / F.sqrt(nb))


def _grown(tree: DataFrame, level: int) -> DataFrame:
    """``tree`` with the templates of paths that go on grown by the segment at ``level``."""
    node = ["host", "template"]
    tree = tree.withColumn("segment", F.get("segments", F.lit(level)))
    going, ended = tree.filter("segment is not null"), tree.filter("segment is null")
    ends = F.sum(F.when(F.size("segments") == level + 1, F.col("n")).otherwise(0))
    children = going.groupBy(*node, "segment").agg(*(F.sum(c).alias(c) for c in ("n", "labelled", "blocked")), ends.alias("ends"))
    sums = children.groupBy(*node).agg(F.count("*").alias("children"), *(F.sum(c).alias(f"all_{c}") for c in ("n", "labelled", "blocked", "ends")))
    children = attach(children, sums, node, ["segment"])
    for c in ("n", "labelled", "blocked", "ends"):
        children = children.withColumn(f"rest_{c}", F.col(f"all_{c}") - F.col(c))
    rare = (F.col("children") > FANOUT) & (F.col("n") * FANOUT < F.col("all_n"))
    told_apart = _differ("blocked", "labelled", "rest_blocked", "rest_labelled") | _differ("ends", "n", "rest_ends", "rest_n")
    alike = (F.col("labelled") > 0) & (F.col("rest_labelled") > 0) & ~told_apart
    named = children.select(*node, "segment", F.when(rare | alike, "?").otherwise(F.col("segment")).alias("name"))
    grown = attach(going, named, [*node, "segment"], ["key"]).withColumn("template", F.concat("template", F.lit("/"), "name")).drop("name")
    return grown.unionByName(ended).drop("segment")


def templates(counts: DataFrame, depth: int = DEPTH, weight: float = WEIGHT, reject: float = REJECT) -> DataFrame:
    """``counts (key, host, shape, n, labelled, blocked)`` with ``template``, its smoothed
    ``purity`` and ``rejected``.

    One row for each (host, shape), with its URLs, how many of them are labelled, and how
    many are labelled as blocked. Without any label nothing is rejected; an empty table
    gives no rows.
    """
    bare = F.when(F.col("shape") == "", F.array().cast("array<string>")).otherwise(F.split(F.expr("substring(shape, 2)"), "/", depth))
    tree, _ = written(counts.withColumn("segments", bare).withColumn("template", F.lit("")), "url-tree")
    known = tree.agg(F.max(F.size("segments")).alias("levels"), F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked")).first()
    for level in range(known.levels or 0):
        tree, _ = written(_grown(tree, level), f"url-tree-{level}")
    tree = tree.drop("segments")
    share = known.blocked / known.labelled if known.labelled else 0.0
    shapes = tree.groupBy("shape").agg(F.sum("labelled").alias("shape_labelled"), F.sum("blocked").alias("shape_blocked"))
    sums = ("labelled", "blocked", "shape_labelled", "shape_blocked")
    judged = attach(tree, shapes, ["shape"], ["host"]).groupBy("host", "template").agg(*(F.sum(c).alias(c) for c in sums))
    prior = (F.col("shape_blocked") + F.lit(weight * share)) / (F.col("shape_labelled") + F.lit(weight))
    purity = (F.col("blocked") + F.lit(weight) * prior) / (F.col("labelled") + F.lit(weight))
    judged = judged.select("host", "template", purity.alias("purity"), (purity >= reject).alias("rejected"))
    return attach(tree, judged, ["host", "template"], ["key"])


def judge_urls(pages: DataFrame, rules: Sequence[Rule], id_col: str = "page_id", url_col: str = "url", label_col: str | None = None, **options) -> DataFrame:
    """``(id, host, path, rule, verdict, template, purity)`` for every row of ``pages``.

    ``rule`` is the longest rule that fits, and then decides; else ``verdict`` is ``block``
    for a rejected template and ``allow`` for the others. The labels that templates learn
    from are ``allow`` or ``block`` in ``label_col``, and the rules' verdicts where that
    is null or not given. ``options`` go to ``templates``.

    Null urls and urls without ``://`` have an empty host and path, and the template of
    those; rows without id are judged like others; each of several equal urls counts and has
    its row; an empty table gives no rows; other columns are not read.
    """
    host, path = host_and_path(F.col(url_col))
    own = F.col(label_col) if label_col else F.lit(None).cast("string")
    urls = pages.select(F.col(id_col), host.alias("host"), path.alias("path"), own.alias("label"))
    urls = urls.withColumn("rule", fitting(rules, F.col("host"), F.col("path"), "name")).withColumn("ruled", fitting(rules, F.col("host"), F.col("path"), "verdict"))
    urls = urls.withColumn("label", F.coalesce("label", "ruled")).withColumn("shape", F.regexp_replace("path", "[0-9]+", "#"))
    urls = urls.withColumn("key", F.unhex(F.sha2(F.concat("host", "shape"), 256)))  # a shape is empty or starts with "/"
    counts = urls.groupBy("key", "host", "shape").agg(
        F.count("*").alias("n"), F.count(F.when(F.col("label").isin("allow", "block"), 1)).alias("labelled"), F.count(F.when(F.col("label") == "block", 1)).alias("blocked")
    )
    found, _ = written(templates(counts, **options).select("key", "n", "template", "purity", "rejected"), "url-templates")
    total = found.agg(F.sum("n")).first()[0] or 0
    hot, cold = found.filter(F.col("n") * HOT > total).drop("n"), found.filter(F.col("n") * HOT <= total).drop("n")
    rare = urls.join(F.broadcast(hot.select("key")), "key", "left_anti").join(cold, "key")
    both = urls.join(F.broadcast(hot), "key").unionByName(rare)
    verdict = F.coalesce("ruled", F.when(F.col("rejected"), "block").otherwise("allow"))
    return both.select(id_col, "host", "path", "rule", verdict.alias("verdict"), "template", "purity")

"""URL filter by a tree of path templates, in DataFrame functions.

Each host has a tree over the segments of its paths, in which segments with a digit are variable and become a
wildcard. It grows level by level: the labelled branches of a node are ordered by their share to block and
cut in two where the likelihood ratio of the two sides is largest, if it reaches ``CUT``; branches on one side are
statistically alike and merge, and their children are pooled before the next level. A merged node whose labels
agree is a leaf, for nothing below it could be told apart, so the tree has no depth limit and grows only as
deep as labels differ. A branch without labels never merges with labelled ones: its template is the path with
its wildcards, whatever the level.

A template is judged by its labelled share to block, smoothed towards that of the same generalised paths over all hosts,
which is smoothed towards the share over all pages. Templates at or above ``REJECT`` are blocked.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import renamed, settle

CUT = 6.63  # of a chi-squared statistic with one degree of freedom, one in a hundred is larger
BINS = 1024
PRIOR = 2.0
REJECT = 0.5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host up to the first ``/``, ``?`` or ``#`` after ``://``, A-Z lowered, and path up to ``?`` or ``#``; else empty."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return (F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER),
            F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """``(rule, verdict)`` of the longest of ``(verdict, host, path)`` that fits host or subdomain and begins the path."""
    rule = verdict = F.lit(None).cast("string")
    for kind, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        rule = F.when(fits, rule_host + rule_path).otherwise(rule)
        verdict = F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def _likelihood(n: Column, hits: Column) -> Column:
    """The largest log-likelihood of ``hits`` among ``n``."""
    def term(part: Column) -> Column:
        return F.when(part > 0, part * F.log(part / n)).otherwise(0.0)
    return term(hits) + term(n - hits)


def _merged(branches: DataFrame) -> DataFrame:
    """``(host, node, segment, l, b)`` of labelled branches -> ``(host, node, segment, name, alike)``.

    ``alike``: all labels under that name agree. Branches are ordered by their share in ``BINS`` steps, so that a window holds no more
    rows than that per node. A branch that is alone on its side keeps its name.
    """
    binned = branches.withColumn("bin", F.floor(F.col("b") * BINS / F.col("l")))
    bins = binned.groupBy("host", "node", "bin").agg(
        F.sum("l").alias("l"), F.sum("b").alias("b"), F.count(F.lit(1)).alias("members"), F.min("segment").alias("only"))
    node = W.partitionBy("host", "node")
    upto = node.orderBy("bin").rowsBetween(W.unboundedPreceding, 0)
    tl, tb, ul, ub = F.sum("l").over(node), F.sum("b").over(node), F.sum("l").over(upto), F.sum("b").over(upto)
    ratio = F.round(2 * (_likelihood(ul, ub) + _likelihood(tl - ul, tb - ub) - _likelihood(tl, tb)), 9)
    best = F.max(F.struct("ratio", (-F.col("bin")).alias("back"))).over(node)
    sided = bins.withColumn("ratio", F.when(tl > ul, ratio).otherwise(0.0)).withColumn("best", best) \
        .withColumn("side", F.when((F.col("best.ratio") >= CUT) & (F.col("bin") > -F.col("best.back")), "?1").otherwise("?0"))
    side = W.partitionBy("host", "node", "side")
    blocked, labelled = F.sum("b").over(side), F.sum("l").over(side)
    named = sided.select(
        "host", "node", "bin", F.when(F.sum("members").over(side) == 1, F.min("only").over(side)).otherwise(F.col("side")).alias("name"),
        ((blocked == 0) | (blocked == labelled)).alias("alike"))
    return binned.join(named, ["host", "node", "bin"]).select("host", "node", "segment", "name", "alike")


def templates(paths: DataFrame) -> DataFrame:
    """``(host, path, n, labelled, blocked)`` -> the same with ``template`` and ``shape``, the path with wildcards.

    In a template ``?0`` and ``?1`` stand for merged branches and ``**`` for all below a leaf; no path holds a question mark.
    """
    segments = F.transform(F.slice(F.split("path", "/"), 2, 1 << 30), lambda s: F.when(s.rlike("[0-9]"), "*").otherwise(s))
    shape = F.array_join(F.transform("segments", lambda s: F.concat(F.lit("/"), s)), "")
    start = paths.withColumn("segments", segments).withColumn("shape", shape).withColumn("node", F.lit("")) \
        .withColumn("template", F.when(F.size("segments") == 0, ""))
    rounds, level = [settle(start, "tree")], 0
    while not rounds[-1].where("template is null").isEmpty():
        level += 1
        active = rounds[-1].where("template is null").drop("template").withColumn("segment", F.element_at("segments", level))
        branches = active.groupBy("host", "node", "segment").agg(F.sum("labelled").alias("l"), F.sum("blocked").alias("b")).where("l > 0")
        grown = active.join(_merged(branches), ["host", "node", "segment"], "left") \
            .withColumn("node", F.concat("node", F.lit("/"), "name"))
        last = F.size("segments") == level
        template = F.when(F.col("name").isNull(), F.col("shape")).when(last, F.col("node")) \
            .when(F.col("alike"), F.concat("node", F.lit("/**")))
        rounds.append(settle(grown.withColumn("template", template).select(*start.columns), "tree"))
    done = [r.where("template is not null").select("host", "path", "n", "labelled", "blocked", "template", "shape") for r in rounds]
    return functools.reduce(DataFrame.unionByName, done)


def judge_pages(pages: DataFrame, rules: list[tuple[str, str, str]], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``(page_id, host, path, rule, verdict, template, purity)``, one row per row of ``pages``.

    A page with a rule has the rule's verdict, and its verdict is the label of its template; others have their
    template's. Null urls and those without ``://`` have an empty host and path and are judged like
    others. Without any label nothing is blocked. Repeated rows count as often as they occur.
    """
    host, path = host_and_path(F.col("url"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    rows = renamed(pages, page_id=id_col, url=url_col).select("page_id", host.alias("host"), path.alias("path")) \
        .withColumn("rule", rule).withColumn("by_rule", verdict)
    paths = rows.groupBy("host", "path").agg(
        F.count(F.lit(1)).alias("n"), F.count("by_rule").alias("labelled"), F.count(F.when(F.col("by_rule") == "block", 1)).alias("blocked"))
    named = settle(templates(paths), "templates")
    total = named.agg(F.sum("labelled"), F.sum("blocked")).first()
    overall = (total[1] or 0) / total[0] if total[0] else 0.0
    pooled = named.groupBy("shape").agg(F.sum("labelled").alias("pl"), F.sum("blocked").alias("pb")).select(
        "shape", ((F.col("pb") + PRIOR * overall) / (F.col("pl") + PRIOR)).alias("prior"))
    priors = named.join(pooled, "shape").groupBy("host", "template").agg(
        F.sum("labelled").alias("l"), F.sum("blocked").alias("b"),
        (F.sum(F.col("prior") * F.col("n")) / F.sum("n")).alias("prior"))
    judged = priors.select("host", "template", F.round((F.col("b") + PRIOR * F.col("prior")) / (F.col("l") + PRIOR), 9).alias("purity"))
    by_path = named.select("host", "path", "template").join(judged, ["host", "template"])
    own = F.when(F.col("purity") >= REJECT, "block").otherwise("allow")
    return rows.join(by_path, ["host", "path"]).select(
        "page_id", "host", "path", "rule", F.coalesce("by_rule", own).alias("verdict"), "template", "purity")

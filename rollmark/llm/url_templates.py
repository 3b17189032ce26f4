"""URL filters: rules, and a tree of path templates that is judged by its labelled share.

Per host, paths form a tree by segments. A segment varies if it is a number, a long hexadecimal
string or the like, or if a node has too many different children; it then becomes a wildcard of
its shape. The few children that stay below a node are compared two by two: branches whose
further shapes and labels differ by no more than chance allows are merged. A template is rejected
if labels cover enough of its urls and their smoothed purity is high enough. A node's statistics
are counts, combined before every shuffle, so a host with a third of all urls costs no more.

Everything is DataFrame operations. Nodes are generalised one by one down to a number of levels that
is a parameter; what lies deeper is one further node, whose children are the whole rests of the paths
by their segments' shapes, so templates that differ far down are told apart, too.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from rollmark.llm.stored import stored


class Rule(NamedTuple):
    verdict: str  #: allow or block
    host: str  #: with all its subdomains
    path: str  #: that the url's path starts with, from its first slash on

    @property
    def name(self) -> str:
        return self.host + self.path


#: Levels of the tree; different children from which a node's segments vary.
LEVELS, CHILDREN = 4, 12
#: A template is rejected from this smoothed share of blocked among labelled urls, if labels cover
#: at least this share of its urls. PRIOR labels are added in the host's proportion.
PURITY, COVERED, PRIOR = 0.8, 0.5, 4.0


def parsed(pages: DataFrame, url: str) -> DataFrame:
    """pages with host and path after its own columns; columns of these names are replaced."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    out = pages.drop("host", "path") if {"host", "path"} & set(pages.columns) - {url} else pages
    out = out.withColumn("_url", F.col(url).cast("string"))
    out = out.withColumn("_rest", F.expr(
        "CASE WHEN locate('://', _url) > 0 THEN substring(_url, locate('://', _url) + 3) ELSE '' END"))
    out = out.withColumn("_host", F.regexp_extract("_rest", r"^[^/?#]*", 0))
    out = out.withColumn("path", F.regexp_extract(F.expr("substring(_rest, length(_host) + 1)"), r"^[^?#]*", 0))
    return out.withColumn("host", F.translate("_host", upper, lower)).drop("_url", "_rest", "_host")


def with_rule(urls: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """urls (host, path) with `rule`, the name of the longest that fits, and `ruled`, its verdict."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((F.col("host") == r.host) | F.col("host").endswith("." + r.host)) & F.col("path").startswith(r.path)
        name, verdict = F.when(fits, r.name).otherwise(name), F.when(fits, r.verdict).otherwise(verdict)
    return urls.withColumn("rule", name).withColumn("ruled", verdict)


def _shape(segment: Column) -> Column:
    """A wildcard for segments that vary by their form alone, else the segment."""
    return (
        F.when(segment.rlike(r"^[0-9]+$"), "{number}")
        .when(segment.rlike(r"^[0-9]+\.[A-Za-z]+$"), F.concat(F.lit("{number}."), F.regexp_extract(segment, r"[A-Za-z]+$", 0)))
        .when(segment.rlike(r"^[0-9a-fA-F-]{16,}$"), "{hex}")
        .when(segment.rlike(r"^(?=.*[0-9])[A-Za-z0-9_.-]{12,}$"), "{code}")
        .otherwise(segment)
    )


def _generalised(paths: DataFrame, levels: int, children: int) -> DataFrame:
    """paths (host, path, n, allowed, blocked) with an array `parts` of segments and wildcards."""
    out = paths.withColumn("segments", F.expr("filter(split(path, '/'), x -> x != '')"))
    out = out.withColumn("parts", F.expr("cast(array() as array<string>)"))
    for level in range(1, levels + 1):
        out = out.withColumn("own", _shape(F.get("segments", F.lit(level - 1))))
        counted = out.filter("own is not null and not startswith(own, '{')").groupBy("host", "parts", "own").agg(
            F.sum("n").alias("n"))
        wide = counted.groupBy("host", "parts").agg(F.count("*").alias("children")).filter(
            F.col("children") > children).select("host", "parts", F.lit(True).alias("wide"))
        out = out.join(wide, ["host", "parts"], "left")
        part = F.when(F.col("wide") & ~F.col("own").startswith("{"), "{name}").otherwise(F.col("own"))
        out = out.withColumn("parts", F.when(F.col("own").isNull(), F.col("parts")).otherwise(
            F.concat("parts", F.array(part)))).drop("own", "wide")
        out = stored(out, "paths")
    deep = F.transform(F.slice("segments", levels + 1, F.greatest(F.size("segments") - levels, F.lit(0))), _shape)
    out = out.withColumn("rest", deep)
    wide = out.filter("size(rest) > 0").groupBy("host", "parts").agg(
        F.count_distinct("rest").alias("children")).filter(F.col("children") > children)
    out = out.join(wide.select("host", "parts", F.lit(True).alias("wide")), ["host", "parts"], "left")
    varies = F.transform("rest", lambda x: F.when(x.startswith("{"), x).otherwise("{name}"))
    rest = F.when(F.col("wide"), varies).otherwise(F.col("rest"))
    return stored(out.withColumn("parts", F.concat("parts", rest)).drop("segments", "rest", "wide"), "paths")


def _merged(paths: DataFrame, level: int) -> DataFrame:
    """Give similar sibling branches at this level one name: that of the smallest they are like."""
    node = [F.col("host"), F.slice("parts", 1, level - 1).alias("above"), F.get("parts", F.lit(level - 1)).alias("own")]
    tail = F.expr(f"array_join(slice(parts, {level + 1}, size(parts)), '/')")
    below = paths.filter(F.size("parts") >= level).select(
        *node, tail.alias("tail"), "n", "allowed", "blocked").filter("not startswith(own, '{')")
    shapes = below.groupBy("host", "above", "own", "tail").agg(
        *(F.sum(c).alias(c) for c in ("n", "allowed", "blocked")))
    branch = shapes.groupBy("host", "above", "own").agg(
        F.sum("n").alias("n"), F.sum("allowed").alias("allowed"), F.sum("blocked").alias("blocked"),
        F.sum(F.col("n") * F.col("n")).alias("square"))
    key = ["host", "above"]
    a, b = (branch.select(*key, *(F.col(c).alias(f"{c}_{s}") for c in branch.columns if c not in key)) for s in "ab")
    x, y = (shapes.select(*key, "tail", F.col("own").alias(f"own_{s}"), F.col("n").alias(f"m_{s}")) for s in "ab")
    common = x.join(y, [*key, "tail"]).filter("own_a < own_b").groupBy(*key, "own_a", "own_b").agg(
        F.sum(F.col("m_a") * F.col("m_b")).alias("product"))
    pairs = b.join(a, key).filter("own_a < own_b").join(common, [*key, "own_a", "own_b"], "left")
    chance = F.expr("sqrt(1 / n_a) + sqrt(1 / n_b)")
    distance = F.expr("square_a / (n_a * n_a) + square_b / (n_b * n_b) - 2 * coalesce(product, 0) / (n_a * n_b)")
    rate = F.expr("abs(blocked_a / nullif(allowed_a + blocked_a, 0) - blocked_b / nullif(allowed_b + blocked_b, 0))")
    labels = F.expr("sqrt(1 / nullif(allowed_a + blocked_a, 0)) + sqrt(1 / nullif(allowed_b + blocked_b, 0))")
    covered = F.expr("abs((allowed_a + blocked_a) / n_a - (allowed_b + blocked_b) / n_b)")
    alike = (F.sqrt(F.greatest(distance, F.lit(0.0))) <= chance) & (
        F.coalesce(rate <= 0.5 * labels, F.lit(True))) & (covered <= 0.5 * chance)
    named = pairs.filter(alike).groupBy(*key, "own_b").agg(F.min("own_a").alias("name")).withColumnRenamed("own_b", "own")
    out = paths.withColumns({"above": F.slice("parts", 1, level - 1), "own": F.get("parts", F.lit(level - 1))})
    out = out.join(named, [*key, "own"], "left")
    renamed = F.concat("above", F.array("name"), F.slice("parts", level + 1, F.size("parts")))
    return out.withColumn("parts", F.when(F.col("name").isNotNull(), renamed).otherwise(F.col("parts"))).drop(
        "above", "own", "name")


def templates(
    labelled: DataFrame, levels: int = LEVELS, children: int = CHILDREN, purity: float = PURITY,
    covered: float = COVERED, prior: float = PRIOR,
) -> DataFrame:
    """(host, path, label), label being allow, block or null -> one row per host and path: template,
    its urls n, labelled, blocked, its purity and whether it is rejected."""
    paths = labelled.groupBy("host", "path").agg(
        F.count("*").alias("n"), F.count(F.when(F.col("label") == "allow", 1)).alias("allowed"),
        F.count(F.when(F.col("label") == "block", 1)).alias("blocked"))
    out = _generalised(stored(paths, "paths"), levels, children)
    for level in range(levels, 0, -1):
        out = stored(_merged(out, level), "paths")
    out = out.withColumn("template", F.concat(F.lit("/"), F.array_join("parts", "/"))).drop("parts")
    sums = [F.sum(c).alias(c) for c in ("n", "allowed", "blocked")]
    tree = out.groupBy("host", "template").agg(*sums)
    host = tree.groupBy("host").agg(F.sum("allowed").alias("host_allowed"), F.sum("blocked").alias("host_blocked"))
    share = (F.col("host_blocked") + 0.5 * prior) / (F.col("host_allowed") + F.col("host_blocked") + prior)
    known = F.col("allowed") + F.col("blocked")
    judged = tree.join(host, "host").withColumn("purity", (F.col("blocked") + prior * share) / (known + prior))
    judged = judged.select(
        "host", "template", "n", known.alias("labelled"), "blocked", "purity",
        ((F.col("purity") >= purity) & (known >= covered * F.col("n"))).alias("rejected"))
    return out.select("host", "path", "template").join(judged, ["host", "template"])


def judge(pages: DataFrame, rules: Sequence[Rule], url: str = "url", **options) -> DataFrame:
    """pages with host, path, rule, template and verdict after its own columns; columns of these
    names are replaced.

    A rule's verdict stands; it also is the label that templates learn from. A url without a rule
    is blocked if its template is rejected, else allowed. A null url, or one without `://`, has an
    empty host and path and is judged like any other. Repeated rows count as often as they occur.
    No rows give no rows.
    """
    added = ("rule", "ruled", "template", "verdict")
    urls = with_rule(parsed(pages.drop(*[c for c in added if c != url]), url), rules)
    tree = templates(urls.select("host", "path", F.col("ruled").alias("label")), **options)
    out = urls.join(tree.select("host", "path", "template", "rejected"), ["host", "path"], "left")
    verdict = F.coalesce("ruled", F.when(F.col("rejected"), "block").otherwise("allow"))
    return out.withColumn("verdict", verdict).select(
        *[c for c in urls.columns if c != "ruled"], "template", "verdict")

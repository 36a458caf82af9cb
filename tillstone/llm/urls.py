"""URL filter: rules by host and path, and a path-template tree per host for what no rule judges.

Rules
    (verdict, host and path). A rule fits its host and all subdomains if the path starts with the rule's; the longest wins,
    of equals the first given. They are a short list, written into the plan as one CASE.

Templates
    Each host has a tree of path segments, grown from the root one level at a time. A segment becomes a wildcard if its
    form says that it varies (numbers, dates, hexadecimal names; an ending like ``.html`` stays), or if its node has
    ``MANY`` children or more and it stands for less than ``RARE`` of the node's pages. Segments from ``DEPTH`` on are one.
    Then the tree is gone through once more, level by level from the leaves up: branches that differ in the literal segment of that
    level alone are merged into one with a wildcard there, if their shares of bad labels don't differ significantly from
    those of the branches beside them (two-proportion test, ``SIGNIFICANT``); a branch without labels is not merged.
    A template is rejected if its smoothed share of bad labels, (bad + 1) / (labels + 2), exceeds ``PURITY``.

Labels are pages known as bad or good; by default those that the rules judge.

How the work is dealt out
    Pages are first counted per host and path; nodes are counted by hash aggregation with sums made before the shuffle,
    and found again by equi-joins. No host's paths are gathered in a task.

Defined results
    A null url, or one without ``://``, has empty host and path; such pages form one host of their own. Rows are judged by
    url, so null or repeated page ids need no care. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstone.plans.session import settled

RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)

MANY = 20
RARE = 0.05
DEPTH = 8
SIGNIFICANT = 1.96
PURITY = 0.7

#: Forms that vary: numbers and dates, and names of eight or more hexadecimal digits or dashes with a digit in them.
_VARIES = r"^([0-9][0-9._-]*|(?=[0-9a-fA-F-]*[0-9])[0-9a-fA-F-]{8,})(\.[a-zA-Z]{1,5})?$"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What stands between the first :// and the path in lower case (A-Z), and the path; both empty without ://."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def _by_rules(rules: Sequence[tuple[str, str]], value) -> Column:
    out = None
    for verdict, rule in sorted(rules, key=lambda r: -len(r[1])):
        host, slash, path = rule.partition("/")
        fits = ((F.col("host") == host) | F.endswith(F.col("host"), F.lit("." + host))) & F.startswith(F.col("path"), F.lit(slash + path))
        out = (F if out is None else out).when(fits, F.lit(value(verdict, rule)))
    return F.lit(None).cast("string") if out is None else out


def ruled(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, id_column: str = "page_id", url_column: str = "url") -> DataFrame:
    """(page_id, host, path, rule, ruled) per page; rule and its verdict are null where none fits."""
    host, path = host_and_path(F.col(url_column))
    parts = pages.select(F.col(id_column).alias("page_id"), host.alias("host"), path.alias("path"))
    return parts.select(
        "*", _by_rules(rules, lambda _, rule: rule).alias("rule"), _by_rules(rules, lambda verdict, _: verdict).alias("ruled")
    )


def _levels(paths: DataFrame) -> DataFrame:
    """paths: (host, path, n, ...). Adds template, the path's segments with wildcards joined by a slash."""
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    head, tail = F.slice("segments", 1, DEPTH - 1), F.slice("segments", DEPTH, 1 << 30)
    paths = paths.withColumn("segments", segments)
    folded = F.when(F.size("segments") >= DEPTH, F.concat(head, F.array(F.array_join(tail, "/")))).otherwise(F.col("segments"))
    paths = settled(paths.withColumn("segments", folded).withColumn("template", F.lit("")), "url-paths")
    deepest = paths.agg(F.max(F.size("segments"))).first()[0] or 0
    for level in range(deepest):
        segment = F.get("segments", F.lit(level))
        ending = F.regexp_extract(segment, _VARIES, 2)
        formed = F.when(F.regexp_like(segment, F.lit(_VARIES)), F.concat(F.lit("*"), ending)).otherwise(segment)
        deep = paths.where(F.size("segments") > level).withColumn("segment", formed)
        children = deep.groupBy("host", "template", "segment").agg(F.sum("n").alias("pages"))
        nodes = children.groupBy("host", "template").agg(F.count("*").alias("children"), F.sum("pages").alias("all_pages"))
        varies = (F.col("children") >= MANY) & (F.col("pages") < RARE * F.col("all_pages")) & (F.substring("segment", 1, 1) != "*")
        named = children.join(nodes, ["host", "template"]).select(
            "host", "template", "segment", F.when(varies, F.lit("*")).otherwise(F.col("segment")).alias("name")
        )
        grown = deep.join(named, ["host", "template", "segment"]).withColumn("template", F.concat("template", F.lit("/"), "name"))
        done = paths.where(F.size("segments") <= level)
        paths = settled(done.unionByName(grown.select(paths.columns)), "url-templates")
    return paths


def _merged(branches: DataFrame, level: int) -> DataFrame:
    """branches: (host, branch, labels, bad). Adds into: the branch with a wildcard at a level, where those that differ
    there alone are alike, else the branch itself."""
    parts = F.split("branch", "/", DEPTH + 1)  # what is one segment from DEPTH on stays one
    literal = (F.size(parts) > level) & ~F.startswith(F.get(parts, F.lit(level)), F.lit("*"))
    wild = F.array_join(F.concat(F.slice(parts, 1, level), F.array(F.lit("*")), F.slice(parts, level + 2, 1 << 30)), "/")
    named = branches.withColumn("wild", F.when(literal, wild).otherwise(F.col("branch")))
    beside = named.groupBy("host", "wild").agg(F.sum("labels").alias("all_labels"), F.sum("bad").alias("all_bad"))
    both = named.join(beside, ["host", "wild"])
    others = F.col("all_labels") - F.col("labels")
    pooled = F.col("all_bad") / F.col("all_labels")
    spread = F.sqrt(pooled * (1 - pooled) * (1 / F.col("labels") + 1 / others))
    apart = F.abs(F.col("bad") / F.col("labels") - (F.col("all_bad") - F.col("bad")) / others)
    alike = F.when((F.col("labels") > 0) & (others > 0), apart <= SIGNIFICANT * spread).otherwise(F.lit(False))
    return both.withColumn("into", F.when(alike, F.col("wild")).otherwise(F.col("branch"))).select(*branches.columns, "into")


def templates(paths: DataFrame, purity: float = PURITY) -> DataFrame:
    """paths: (host, path, template, n, labels, bad). Returns (host, template, branch, share, rejected): the branch a
    template was merged into, its smoothed share of bad labels, and whether that is too much.

    Branches are merged level by level from the leaves up; what was merged below meets as one branch above."""
    leaves = paths.groupBy("host", "template").agg(F.sum("labels").alias("labels"), F.sum("bad").alias("bad"))
    names = settled(leaves.withColumn("branch", F.col("template")), "url-branches")
    deepest = names.agg(F.max(F.size(F.split("template", "/", DEPTH + 1)))).first()[0] or 1
    for level in range(deepest - 1, 0, -1):
        branches = names.groupBy("host", "branch").agg(F.sum("labels").alias("labels"), F.sum("bad").alias("bad"))
        into = _merged(branches, level).select("host", "branch", "into")
        named = names.join(into, ["host", "branch"]).select("host", "template", "labels", "bad", F.col("into").alias("branch"))
        names = settled(named, "url-branches")
    shares = names.groupBy("host", "branch").agg(((F.sum("bad") + 1) / (F.sum("labels") + 2)).alias("share"))
    judged = names.select("host", "template", "branch").join(shares, ["host", "branch"])
    return judged.withColumn("rejected", F.col("share") > purity)


def filtered(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    labels: DataFrame | None = None,
    id_column: str = "page_id",
    url_column: str = "url",
) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, share) per page. labels: (page_id, bad boolean), one row a page."""
    known = ruled(pages, rules, id_column, url_column)
    if labels is None:
        bad = F.col("ruled") == "block"
    else:
        known = known.join(labels.select("page_id", F.col("bad").alias("_bad")), "page_id", "left")
        bad = F.col("_bad")
    counted = known.groupBy("host", "path").agg(
        F.count("*").alias("n"), F.count(bad).alias("labels"), F.coalesce(F.sum(bad.cast("long")), F.lit(0)).alias("bad")
    )
    paths = _levels(counted)
    judged = paths.join(templates(paths), ["host", "template"]).select("host", "path", "branch", "share", "rejected")
    verdict = F.coalesce("ruled", F.when(F.col("rejected"), F.lit("block")).otherwise(F.lit("allow")))
    return known.join(judged, ["host", "path"]).select(
        "page_id", "host", "path", "rule", verdict.alias("verdict"), F.col("branch").alias("template"), "share"
    )

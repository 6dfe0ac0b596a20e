"""URL filters: trust and distrust propagated over the links between hosts, after rules on single urls.

Personalised PageRank runs twice over the host graph: trust from trusted seeds along the links, distrust from blocked seeds
against them (who links to a bad host is suspect). A page that no rule decides gets its host's verdict: blocked where
its share of distrust exceeds ``threshold`` times its share of trust. Edges come from absolute links in the pages, and from each
host to the hosts above and below it in name, which share an owner; relative links stay on their host.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cohortlens.llm.store import stored

RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
DAMPING = 0.85
ROUNDS = 12
CUT = 4  # rounds in one plan
THRESHOLD = 1.0
LINK = r"""(?i)\bhref\s*=\s*["']?([a-z][a-z0-9+.-]*://[^\s"'<>]*)"""
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def decided(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """``struct(rule, verdict)`` of the longest rule that fits, or null. A rule fits its host and all hosts below it."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def host_edges(pages: DataFrame, hosts: DataFrame) -> DataFrame:
    """``src, dst, w``: distinct pages with a link from one host to another, and 1 for the host above in name."""
    linked = pages.select("row_id", F.col("host").alias("src"), F.explode("links").alias("url"))
    linked = linked.select("row_id", "src", host_of(F.col("url")).alias("dst")).where("src <> '' AND dst <> '' AND src <> dst").distinct()
    counted = linked.groupBy("src", "dst").agg(F.count("*").cast("double").alias("w"))
    above = hosts.select(F.col("host").alias("src"), F.regexp_extract("host", r"^[^.]+\.(.+\..+)$", 1).alias("dst")).where("dst <> ''")
    named = above.unionByName(above.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).withColumn("w", F.lit(1.0))
    return counted.unionByName(named).groupBy("src", "dst").agg(F.sum("w").alias("w"))


def personalised_rank(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS, label: str = "rank") -> DataFrame:
    """``host, rank``: mass that starts at ``seeds`` (``host, start``, summing to 1) and follows ``edges`` (``src, dst, w``).

    Mass that reaches a host without out-edges ends there. Each round joins the ranks with the out-edges and sums by target; heavy
    hosts are left to adaptive skew handling, and sums are partial before they move. Every ``CUT`` rounds are written.
    """
    weights = edges.groupBy("src").agg(F.sum("w").alias("all"))
    steps = stored(edges.join(weights, "src").select("src", "dst", (F.col("w") / F.col("all")).alias("p")), f"{label}_steps")
    begin = seeds.select("host", F.col("start").alias("rank"))
    again = seeds.select("host", ((1 - damping) * F.col("start")).alias("rank"))
    rank = begin
    for i in range(1, rounds + 1):
        moved = steps.join(rank, steps["src"] == rank["host"]).select(F.col("dst").alias("host"), (damping * F.col("rank") * F.col("p")).alias("rank"))
        rank = moved.unionByName(again).groupBy("host").agg(F.sum("rank").alias("rank"))
        if i % CUT == 0 or i == rounds:
            rank = stored(rank, f"{label}_{i}")
    return rank


def judge(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    rules: Sequence[tuple[str, str, str]] = RULES,
    threshold: float = THRESHOLD,
    edges: DataFrame | None = None,
    trusted: DataFrame | None = None,
    blocked: DataFrame | None = None,
) -> DataFrame:
    """``id, host, path, rule, verdict, trust, distrust``, one row per row of ``pages``.

    Seeds (``host``): those given, or the hosts with more pages that a rule allows (blocks) than pages that a rule blocks (allows).
    A host that neither mass reaches is allowed. Null url or no ``://``: empty host and path, allowed. Null html: no
    links. Repeated rows count as pages of their own. Empty table: no rows. Extra columns are not read.
    """
    url = F.col(url_col).cast("string")
    base = pages.select(
        F.monotonically_increasing_id().alias("row_id"),
        F.col(id_col).alias("id"),
        host_of(url).alias("host"),
        path_of(url).alias("path"),
        F.array_distinct(F.regexp_extract_all(F.coalesce(F.col(html_col).cast("string"), F.lit("")), F.lit(LINK), F.lit(1))).alias("links"),
    )
    rows = stored(base.withColumn("by", decided(F.col("host"), F.col("path"), rules)), "pages")
    hosts = stored(
        rows.where("host <> ''").groupBy("host").agg(F.sum((F.col("by.verdict") == "allow").cast("int")).alias("a"), F.sum((F.col("by.verdict") == "block").cast("int")).alias("b")),
        "hosts",
    )
    graph = stored(edges if edges is not None else host_edges(rows, hosts), "edges")
    good = trusted if trusted is not None else hosts.where(F.coalesce("a", F.lit(0)) > F.coalesce("b", F.lit(0)))
    bad = blocked if blocked is not None else hosts.where(F.coalesce("b", F.lit(0)) > F.coalesce("a", F.lit(0)))
    trust = personalised_rank(graph, _even(good), label="trust").withColumnRenamed("rank", "trust")
    against = graph.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "w")
    distrust = personalised_rank(against, _even(bad), label="distrust").withColumnRenamed("rank", "distrust")
    scores = trust.join(distrust, "host", "full")
    t, d = F.coalesce("trust", F.lit(0.0)), F.coalesce("distrust", F.lit(0.0))
    by_host = F.when(d > threshold * t, "block").otherwise("allow")
    return rows.drop("links").join(scores, "host", "left").select(
        "id", "host", "path", F.col("by.rule").alias("rule"), F.coalesce("by.verdict", by_host).alias("verdict"), t.alias("trust"), d.alias("distrust")
    )


def _even(seeds: DataFrame) -> DataFrame:
    """The seeds with equal mass; none if there are none."""
    seeds = seeds.select("host").distinct()
    n = seeds.count()
    return seeds.withColumn("start", F.lit(1.0 / max(1, n)))

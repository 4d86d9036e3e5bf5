"""Allow and block verdicts for page urls: rules first, then a link graph.

Trust spreads from hosts with allowed pages along links (personalised PageRank),
distrust from hosts with blocked pages against them. A host where distrust
outweighs trust is blocked. DataFrame functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilldeck.llm.graph import written

RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)
DAMPING = 0.85
# Share of all seeds by which a rank may still move when rounds end.
TOLERANCE = 1e-6
# Rounds after which ranks are written and their lineage ends.
_CUT = 5
# Distrust per trust from which on a host is blocked.
MOST_DISTRUST = 1.0
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_LINK = r"""(?is)<a\s[^>]*?href\s*=\s*["']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^"'\s>]*)"""


def host_of(url: str | Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    url = F.col(url) if isinstance(url, str) else url
    return F.coalesce(F.translate(F.regexp_extract(url, _URL, 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: str) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def host_links(pages: DataFrame, url_column: str = "url", html_column: str = "html") -> DataFrame:
    """``source``, ``target``, ``links``: absolute links between different hosts.

    Counted before the shuffle, so a host with a third of all pages is one row
    per task and target."""
    target = F.explode(F.regexp_extract_all(html_column, F.lit(_LINK), F.lit(1)))
    return (
        pages.select(host_of(url_column).alias("source"), target.alias("url"))
        .select(
            "source", host_of(F.when(F.col("url").startswith("//"), F.concat(F.lit("http:"), "url")).otherwise(F.col("url"))).alias("target")
        )
        .where("source != '' and target != '' and source != target")
        .groupBy("source", "target")
        .agg(F.count("*").alias("links"))
    )


def spread(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """``host``, ``rank``: each round a host keeps 1 - ``damping`` of its seed and
    passes ``damping`` of its rank on, by the weight of its ``source`` edges.

    Rounds go on until no host's rank has moved by more than ``tolerance`` of all seeds
    between two written tables of ranks, so hosts any number of links away are reached
    as long as what reaches them counts. What a host without edges would pass on is
    lost. ``edges``: source, target, links; ``seeds``: host, seed.
    """
    total = edges.groupBy("source").agg(F.sum("links").alias("total"))
    weights = written(
        edges.join(total, "source").select("source", "target", (F.col("links") / F.col("total")).alias("weight")),
        "link-weights",
    )
    base = seeds.where("seed > 0").select("host", (F.col("seed") * (1 - damping)).alias("rank"))
    least = tolerance * (seeds.where("seed > 0").agg(F.sum("seed")).first()[0] or 0)
    ranks = before = written(base, "ranks")
    moved = math.inf
    while moved > least:
        for _ in range(_CUT):
            passed = weights.join(ranks, weights["source"] == ranks["host"]).select(
                F.col("target").alias("host"), (F.col("rank") * F.col("weight") * damping).alias("rank")
            )
            ranks = base.union(passed).groupBy("host").agg(F.sum("rank").alias("rank"))
        ranks = written(ranks, "ranks")
        both = ranks.join(before.withColumnRenamed("rank", "was"), "host", "full")
        change = F.abs(F.coalesce("rank", F.lit(0.0)) - F.coalesce("was", F.lit(0.0)))
        moved, before = both.agg(F.max(change)).first()[0] or 0.0, ranks
    return ranks


def _hosts_with_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """The rules of each host and its parent domains, as one short array a host."""
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    fits = (
        hosts.select("host", F.explode(suffixes).alias("rule_host"))
        .join(rules, "rule_host")
        .groupBy("host")
        .agg(F.collect_list(F.struct(F.length("rule").alias("size"), "rule", "rule_path", "rule_verdict")).alias("rules"))
    )
    return hosts.join(fits, "host", "left")


def url_verdicts(
    pages: DataFrame,
    rules: tuple[tuple[str, str], ...] = RULES,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
    damping: float = DAMPING,
    tolerance: float = TOLERANCE,
    most_distrust: float = MOST_DISTRUST,
) -> DataFrame:
    """One row per page: id, ``host``, ``path``, ``rule``, ``verdict`` and the
    host's ``trust`` and ``distrust``.

    A rule (host and path in one string) fits its host and all subdomains where
    the path starts with the rule's; the longest fitting one decides. Without a
    rule the host decides: block if its distrust is more than ``most_distrust``
    times its trust, else allow. Seeds are a host's pages allowed and blocked by
    rule, so a host may be both.

    Urls that are null or hold no ``://`` have an empty host and path, no rule,
    and are allowed; their host takes no part in the graph. Null html holds no
    link. Repeated rows count once each. Other columns are not looked at.
    """
    spark = pages.sparkSession
    listed = spark.createDataFrame(
        [(r, r.partition("/")[0], "/" + r.partition("/")[2], v) for r, v in rules],
        "rule string, rule_host string, rule_path string, rule_verdict string",
    )
    split = pages.select(
        F.col(id_column).alias("page"), host_of(url_column).alias("host"), path_of(url_column).alias("path")
    )
    hosts = split.select("host").where("host != ''").distinct()
    with_rules = written(_hosts_with_rules(hosts, listed), "host-rules")
    fitting = F.filter("rules", lambda r: F.col("path").startswith(r["rule_path"]))
    best = F.array_max(fitting)
    judged = split.join(with_rules, "host", "left").select(
        "page", "host", "path", best["rule"].alias("rule"), best["rule_verdict"].alias("ruled")
    )
    seeds = (
        judged.where("ruled is not null").groupBy("host", "ruled").agg(F.count("*").alias("seed"))
    )
    seeds = written(seeds, "seeds")
    edges = written(host_links(pages, url_column, html_column), "host-links")
    good, bad = (seeds.where(F.col("ruled") == v).select("host", "seed") for v in ("allow", "block"))
    back = edges.select(F.col("target").alias("source"), F.col("source").alias("target"), "links")
    # Without links between hosts seeds alone have ranks.
    ranked = seeds.select("host", "ruled", (F.col("seed") * (1 - damping)).alias("rank"))
    trust, distrust = (ranked.where(F.col("ruled") == v).select("host", "rank") for v in ("allow", "block"))
    if not edges.isEmpty():
        trust, distrust = spread(edges, good, damping, tolerance), spread(back, bad, damping, tolerance)
    trust, distrust = trust.withColumnRenamed("rank", "trust"), distrust.withColumnRenamed("rank", "distrust")
    zero = F.lit(0.0)
    scores = (
        hosts.join(trust, "host", "left")
        .join(distrust, "host", "left")
        .select("host", F.coalesce("trust", zero).alias("trust"), F.coalesce("distrust", zero).alias("distrust"))
    )
    scores = written(scores, "host-scores")
    by_host = F.when(F.col("distrust") > most_distrust * F.col("trust"), "block").otherwise("allow")
    return judged.join(scores, "host", "left").select(
        F.col("page").alias(id_column), "host", "path", "rule", F.coalesce("ruled", by_host).alias("verdict"), "trust", "distrust"
    )

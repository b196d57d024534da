r"""URL filters with link-graph propagation.

Rules name a host (with its subdomains) and a path prefix; the longest that fits a page decides. Pages without a rule get the verdict of
their host: trust spreads from hosts with allowed pages along links, distrust from hosts with blocked pages against them
(who links to a blocked host is suspect), both as personalised PageRank over weighted host edges. A host is blocked when
its share of all distrust is above ``MARGIN`` times its share of all trust; a host that neither reaches is allowed. Both are carried in
pages: a host's own blocked page is 1 of distrust in a table of any size. Rounds go on until what all hosts still receive of either
kind is below a tenth of ``LEAST`` pages divided by the number of hosts, and distrust below that ``LEAST`` share counts as none.

Edges are the links with a host in a page's ``href`` values (http, https, or ``//host``), counted per pair of hosts before anything is
joined, so a hub is one row per neighbour. Each round is one join and one map-side sum. Defined cases: a null url or one without ``://`` has an empty host and path,
fits no rule and is allowed; null html has no links; pages repeated in the table count once each; null ids are passed through; other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from desklake.llm.common import ascii_lower, stored

DAMPING = 0.85
MARGIN, LEAST = 1.0, 1e-6
LINK = r"""(?i)href\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s>]+)"""


@dataclass(frozen=True)
class Rule:
    action: str  # allow or block
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = ascii_lower(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1))
    return host, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Struct (rule, action) of the longest rule that fits; of equally long ones the first by text."""
    chosen = F.lit(None).cast("struct<rule:string,action:string>")
    for rule in sorted(rules, key=lambda r: (len(r.text), [-ord(c) for c in r.text])):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        chosen = F.when(fits, F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.action).alias("action"))).otherwise(chosen)
    return chosen


def host_edges(pages: DataFrame) -> DataFrame:
    """source, target and weight: links between different hosts, as shares of the source's links."""
    source, _ = host_and_path(F.col("url"))
    links = pages.select(source.alias("source"), F.explode(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(LINK), 1)).alias("link"))
    return links.select("source", ascii_lower(F.col("link")).alias("target")).where("source <> target and source <> '' and target <> ''").groupBy(
        "source", "target").agg(F.count(F.lit(1)).alias("links"))


def propagate(edges: DataFrame, seeds: DataFrame, least: float = LEAST, damping: float = DAMPING) -> tuple[DataFrame, float]:
    """host, trust and distrust in pages; and the distrust that counts as none. ``seeds`` has host, trust and distrust in pages.

    Trust moves along the edges and distrust against them. What has moved in a round is all that moves in the next, ``damping``
    times at most, so the rounds end; their sum, divided by its total, is the PageRank in which a host without such edges gives back to the seeds.
    """
    out = edges.groupBy("source").agg(F.sum("links").alias("out"))
    into = edges.groupBy("target").agg(F.sum("links").alias("into"))
    shares = edges.join(out, "source").join(into, "target")
    # One table for both directions: from, to, and how much of either kind moves.
    moves = shares.select(F.col("source").alias("host"), F.col("target").alias("to"), (F.col("links") / F.col("out")).alias("along"),
                          F.lit(0.0).alias("against")).unionByName(
        shares.select(F.col("target").alias("host"), F.col("source").alias("to"), F.lit(0.0).alias("along"),
                      (F.col("links") / F.col("into")).alias("against")))
    moves = stored(moves, "host-moves")
    if moves.isEmpty():
        return seeds, 0.0
    floor = least / moves.select("host").unionByName(seeds.select("host")).distinct().count()
    kinds = ("trust", "distrust")
    ranks = stored(seeds.select("host", *kinds, *[F.col(c).alias(f"new_{c}") for c in kinds]), "host-ranks")
    while True:
        sent = ranks.where("new_trust > 0 or new_distrust > 0").join(moves, "host").select(
            F.col("to").alias("host"), (F.col("new_trust") * F.col("along") * damping).alias("new_trust"),
            (F.col("new_distrust") * F.col("against") * damping).alias("new_distrust"))
        both = sent.unionByName(ranks.select("host", *kinds), allowMissingColumns=True).groupBy("host")
        now = {c: F.coalesce(F.sum(c), F.lit(0.0)) for c in (*kinds, "new_trust", "new_distrust")}
        ranks = stored(both.agg(*[(now[c] + now[f"new_{c}"]).alias(c) for c in kinds], *[now[f"new_{c}"].alias(f"new_{c}") for c in kinds]), "host-ranks")
        moved = ranks.agg(F.sum("new_trust"), F.sum("new_distrust")).first()
        if max(value or 0.0 for value in moved) <= floor / 10:
            return ranks.select("host", *kinds), floor


def judge(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """page_id, host, path, rule, verdict, and the host's trust and distrust."""
    host, path = host_and_path(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"))
    placed = stored(parsed.withColumn("fit", fitting_rule(F.col("host"), F.col("path"), rules)), "placed-pages")
    counts = placed.where("host <> ''").groupBy("host").agg(
        F.count_if(F.col("fit.action") == "allow").cast("double").alias("trust"),
        F.count_if(F.col("fit.action") == "block").cast("double").alias("distrust"))
    seeds = stored(counts.where("trust > 0 or distrust > 0"), "host-seeds")
    pages_of, floor = propagate(stored(host_edges(pages.select("url", "html")), "host-edges"), seeds)
    totals = pages_of.agg(F.sum("trust"), F.sum("distrust")).first()
    ranks = pages_of.select("host", (F.col("distrust") > floor).alias("suspect"), *[
        (F.col(c) / F.lit(total or 1.0)).alias(c) for c, total in zip(("trust", "distrust"), totals)])
    bad = F.col("suspect") & (F.col("distrust") > F.col("trust") * MARGIN)
    return placed.join(ranks, "host", "left").select(
        "page_id", "host", "path", F.col("fit.rule").alias("rule"),
        F.coalesce(F.col("fit.action"), F.when(bad, "block").otherwise("allow")).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))

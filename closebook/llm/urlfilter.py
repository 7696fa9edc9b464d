"""URL filters: rules for hosts and paths, and trust spread over the links between hosts.

Rules decide the urls they fit. Their verdicts seed a graph of host links:
trust spreads from allowed hosts along links, distrust from blocked hosts
against them, both as personalised PageRank. A host without a rule is blocked
if its distrust exceeds its trust by a threshold. Built-in functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closebook.llm.common import free_prefix, hand_over, remove, without
from closebook.session import fresh_path

ALLOW, BLOCK = "allow", "block"
#: Part of a rank that follows links, units of a whole seed.
DAMPING, UNITS = 0.85, 10**12

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LINK = r"""(?i)<a\s(?:[^>]*?\s)?href\s*=\s*["']?([^"'\s>]*)"""


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    def __str__(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """What follows the first :// up to / ? # or the end, A-Z lower-cased; empty if none."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1)
    return F.translate(found, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ? # or the end; empty if none."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Struct of rule and verdict of the longest rule that fits; null if none does.

    A rule fits its host and all subdomains if the path starts with the rule's.
    Of rules of equal length a block goes first, then the first in the list.
    """
    order = sorted(rules, key=lambda r: (-len(str(r)), r.verdict != BLOCK))
    chosen = F.lit(None).cast("struct<rule: string, verdict: string>")
    for rule in reversed(order):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        held = F.struct(F.lit(str(rule)).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        chosen = F.when(fits, held).otherwise(chosen)
    return chosen


def host_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """src, dst and n, the links from pages of one host to another host.

    Links inside a host, relative ones among them, say nothing about it and are
    left out, as are pages and links without a host.
    """
    target = F.col("target")
    other = F.when(target.startswith("//"), host_of(F.concat(F.lit(":"), target))).otherwise(host_of(target))
    links = pages.select(
        host_of(F.col(url)).alias("src"),
        F.explode(F.regexp_extract_all(F.col(html), F.lit(_LINK), F.lit(1))).alias("target"),
    )
    links = links.where(target.contains("://") | target.startswith("//")).select("src", other.alias("dst"))
    links = links.where("src != '' AND dst != '' AND src != dst")
    return links.groupBy("src", "dst").agg(F.count("*").alias("n"))


def spread(seeds: DataFrame, links: DataFrame, damping: float = DAMPING) -> DataFrame:
    """kind, host and rank: trust along ``links`` (src, dst, n), distrust against them.

    ``seeds`` has kind, host and rank in whole units. Each round a host keeps
    1 - ``damping`` of its seed and receives ``damping`` of its neighbours' ranks,
    shared by link counts and rounded down to units, so that the sums do not
    depend on their order. Hosts without links pass nothing on. Ends when a
    round changes nothing, which may take two hundred rounds. Ranks start at
    1 - ``damping`` of the seeds and never fall, so that this comes: the whole
    numbers are bounded by the seeds.
    """
    along = links.select(F.lit("trust").alias("kind"), F.col("src").alias("host"), F.col("dst").alias("to"), "n")
    against = links.select(F.lit("distrust").alias("kind"), F.col("dst").alias("host"), F.col("src").alias("to"), "n")
    edges = along.union(against)
    totals = edges.groupBy("kind", "host").agg(F.sum("n").alias("total"))
    edges = hand_over(edges.join(totals, ["kind", "host"]), "host-links")
    seeds = hand_over(seeds.select("kind", "host", "rank"), "seeds")
    base = seeds.select("kind", "host", F.floor(F.col("rank") * F.lit(1 - damping)).alias("rank"))
    # Multiplied in this order, as the statement in SQL does.
    part = F.floor(F.col("rank") * F.lit(damping) * F.col("n") / F.col("total"))
    ranks, state, old = base, None, None
    while True:
        passed = ranks.join(edges, ["kind", "host"]).select("kind", F.col("to").alias("host"), part.alias("rank"))
        ranks = base.union(passed).groupBy("kind", "host").agg(F.sum("rank").alias("rank"))
        path = fresh_path(ranks.sparkSession, "ranks")
        ranks.write.parquet(path)
        ranks = ranks.sparkSession.read.schema(ranks.schema).parquet(path)
        if old is not None:
            # Nothing reads the round before any more.
            remove(ranks.sparkSession, old)
        old = path
        checked = F.sum(F.xxhash64("kind", "host", "rank").cast("decimal(38,0)"))
        now = tuple(ranks.agg(F.count("*"), checked).first())
        if now == state:
            break
        state = now
    return ranks


def judge(
    pages: DataFrame,
    rules: list[Rule],
    threshold: float = 0.0,
    damping: float = DAMPING,
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """``pages`` with host, path, rule, verdict, trust and distrust.

    The rule's verdict counts; without a rule, a page is blocked if its host's
    distrust exceeds trust by more than ``threshold``, else allowed. A host is a
    trusted (blocked) seed by the part of its pages that a rule allows (blocks); trust
    spreads until nothing changes, see ``spread``. Of a rank, 1 is a whole seed, and a
    host of seeds to which nobody links ends at 1 - ``damping``. A null url, or one without ://, has an
    empty host and path, fits no rule and is allowed. Null or empty html has no
    links. Repeated pages count as often as they occur. Input columns of the six
    names are replaced.
    """
    pages = without(pages, "host", "path", "rule", "verdict", "trust", "distrust")
    w = free_prefix(pages)
    found = pages.withColumns({w + "host": host_of(F.col(url)), w + "path": path_of(F.col(url))})
    found = found.withColumn(w + "rule", rule_for(F.col(w + "host"), F.col(w + "path"), rules))
    ruled = F.col(w + "rule.verdict")
    hosts = found.where(F.col(w + "host") != "").groupBy(F.col(w + "host").alias("host"))
    hosts = hosts.agg(
        F.count("*").alias("pages"),
        F.count_if(ruled == ALLOW).alias("trust"),
        F.count_if(ruled == BLOCK).alias("distrust"),
    )
    seeds = hosts.select("host", "pages", F.stack(F.lit(2), F.lit("trust"), "trust", F.lit("distrust"), "distrust"))
    seeds = seeds.toDF("host", "pages", "kind", "seeded").where("seeded > 0")
    units = F.floor(F.lit(float(UNITS)) * F.col("seeded") / F.col("pages"))
    ranks = spread(seeds.select("kind", "host", units.alias("rank")), host_links(pages, url, html), damping)
    of = {k: F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("rank"))), F.lit(0)) for k in ("trust", "distrust")}
    scored = ranks.groupBy(F.col("host").alias(w + "name")).agg(*[of[k].alias(w + k) for k in of])
    joined = found.join(scored, F.col(w + "host") == F.col(w + "name"), "left")
    trust, distrust = (F.coalesce(F.col(w + k), F.lit(0)).cast("long") for k in ("trust", "distrust"))
    by_host = F.when(distrust - trust > F.lit(int(threshold * UNITS)), F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    return joined.select(
        *pages.columns,
        F.col(w + "host").alias("host"),
        F.col(w + "path").alias("path"),
        F.col(w + "rule.rule").alias("rule"),
        F.coalesce(ruled, by_host).alias("verdict"),
        trust.alias("trust"),
        distrust.alias("distrust"),
    )

"""URL filters: host and path rules, and link-graph propagation of trust and distrust between hosts.

Rules decide first: a rule fits its host and all subdomains if the path starts with the rule's; the longest rule wins.
Hosts that no rule decides on get the verdict of the link graph: personalised PageRank runs from trusted hosts along
links, and from blocked hosts against them (who links to bad hosts is suspect). A host is blocked if its distrust reaches
`least` and is more than its trust.

Only the set of host edges goes through the iterations, each one join and one sum, until ranks converge; links are made distinct per host pair
before, so a host with a third of all pages is one small row group. Ranks are whole numbers of `UNITS`, so that sums don't
depend on order and reruns agree. DataFrame functions only.

Links are values of href attributes, in quotes of either kind or none. A host with no link has none to pass its rank to, which is dropped. Hosts are
compared as the contract of urls cuts them, with a port or user name if there is one. Trust and distrust beyond a long's range are given
as its end; verdicts are made before.

Nulls and urls without "://": host and path are empty, no rule fits, the verdict is allow. Null html has no links.
Repeated rows get a verdict each, long texts are read whole, and a
host with as much trust as distrust is allowed. Empty tables give empty results. Rows keep no other columns than those
returned; names of extra columns don't clash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import lower_ascii, table, written

UNITS = 10**12
#: Rounds between two tests of convergence.
ROUNDS = 8
#: Parts of a rank that follow links, in hundredths; the rest returns to the seeds.
DAMPING = 85
#: A host's distrust below this share of one seed's rank doesn't count, in thousandths.
LEAST = 50
#: Ranks have converged once a round changes all of them together by no more than this part of LEAST, in thousandths.
STILL = 1
HREF = r"""(?i)(?:^|[\s"'/<])href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
#: Ranks are sums over any number of seeds, beyond what a long holds.
RANK = "decimal(38,0)"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (Rule("block", "com", "/en/"), Rule("allow", "example.com", "/en/7"), Rule("allow", "net", "/de/"), Rule("block", "example.net", "/de/8"), Rule("block", "org", "/es/"))


def host_of(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_column(host: Column, path: Column, rules: tuple[Rule, ...], value) -> Column:
    """value(rule) of the longest rule that fits, else null. Rules are a short list, and become one expression."""
    chain = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        chain = F.when(fits, F.lit(value(rule))).otherwise(chain)
    return chain


def judged(pages: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    parts = pages.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    return parts.withColumn("rule", rule_column(F.col("host"), F.col("path"), rules, lambda r: r.name)).withColumn("ruled", rule_column(F.col("host"), F.col("path"), rules, lambda r: r.verdict))


def host_edges(pages: DataFrame) -> DataFrame:
    """source, target: distinct host pairs. A link without a host of its own stays on its page's host."""
    found = F.transform(F.regexp_extract_all("html", F.lit(HREF), F.lit(1)), lambda x: target_host(F.trim(x, F.lit("\"'"))))
    links = pages.where(F.col("host") != "").select("host", F.explode(F.array_distinct(found)).alias("to"))
    return links.select(F.col("host").alias("source"), F.when(F.col("to") == "", F.col("host")).otherwise(F.col("to")).alias("target")).distinct()


def target_host(link: Column) -> Column:
    """Host of an absolute or protocol-relative link, else empty. A scheme stands at the link's start."""
    return lower_ascii(F.regexp_extract(link, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1))


def _divided(number: Column, by: Column) -> Column:
    """number div by, for whole numbers of any size."""
    number, by = number.cast(RANK), by.cast("decimal(19,0)")
    return ((number - number % by) / by).cast(RANK)


def propagate(edges: DataFrame, seeds: DataFrame, rounds: int = ROUNDS, damping: int = DAMPING, least: int = LEAST) -> DataFrame:
    """host, rank: personalised PageRank from `seeds` (host; each starts with UNITS) along edges (source, target), iterated until it
    converges. Every `rounds` rounds ranks are written, and the sum of the last round's changes comes to the driver.

    A round shrinks the sum of all changes to `damping` hundredths at most, so that a host is no further from its final rank than
    damping / (100 - damping) times the last sum; and what is left of the start after n rounds has a bound, at which the loop ends too."""
    if not 0 <= damping < 100 or rounds < 1:
        raise ValueError("damping must be from 0 to 99, and rounds 1 at least")
    degree = edges.groupBy("source").agg(F.count("*").alias("degree"))
    weighted = written(edges.join(degree, "source"))
    start = seeds.select("host", F.lit(UNITS).cast(RANK).alias("rank"))
    none = F.lit(0).cast(RANK)
    back = start.select("host", _divided(F.col("rank") * (100 - damping), F.lit(100)).alias("rank"), none.alias("before"))
    still = max(1, UNITS * least // 1000 * STILL // 1000)
    ranks, change, left = start, None, 2 * UNITS * start.count()
    while left > still and (change is None or change > still):
        for turn in range(rounds):
            flow = weighted.join(ranks, weighted["source"] == ranks["host"]).select(F.col("target").alias("host"), _divided(_divided(F.col("rank") * damping, F.lit(100)), F.col("degree")).alias("rank"), none.alias("before"))
            parts = flow.unionByName(back)
            # only the last round is compared with the one before: ranks read twice in each would double the plan
            if turn == rounds - 1:
                parts = parts.unionByName(ranks.select("host", none.alias("rank"), F.col("rank").alias("before")))
            summed = parts.groupBy("host").agg(F.sum("rank").cast(RANK).alias("rank"), F.sum("before").cast(RANK).alias("before"))
            ranks = summed.select("host", "rank").where("rank > 0")
            left = left * damping // 100
        summed = written(summed)
        change = summed.agg(F.coalesce(F.sum(F.abs(F.col("rank") - F.col("before")).cast(RANK)), F.lit(0))).first()[0]
        ranks = summed.select("host", "rank").where("rank > 0")
    return ranks


def filter_urls(pages: DataFrame, rules: tuple[Rule, ...] = RULES, rounds: int = ROUNDS, damping: int = DAMPING, least: int = LEAST) -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust of every page."""
    rows = judged(pages, rules)
    edges = written(host_edges(rows.select("host", "html")))
    hosts = written(rows.where(F.col("ruled").isNotNull()).groupBy("host").agg(F.max(F.col("ruled") == "allow").alias("trusted"), F.max(F.col("ruled") == "block").alias("blocked")))
    # a host that rules judge both ways is a seed of neither
    trusted = hosts.where("trusted and not blocked").select("host")
    blocked = hosts.where("blocked and not trusted").select("host")
    trust = propagate(edges, trusted, rounds, damping, least).withColumnRenamed("rank", "trust")
    against = edges.select(F.col("target").alias("source"), F.col("source").alias("target"))
    distrust = propagate(against, blocked, rounds, damping, least).withColumnRenamed("rank", "distrust")
    scores = trust.join(distrust, "host", "full").select(F.col("host").alias("of_host"), F.coalesce("trust", F.lit(0).cast(RANK)).alias("trust"), F.coalesce("distrust", F.lit(0).cast(RANK)).alias("distrust"))
    verdicts = scores.withColumn("bad", (F.col("distrust") >= UNITS * least // 1000) & (F.col("distrust") > F.col("trust")))
    slim = rows.select("page_id", "host", "path", "rule", "ruled")
    return slim.join(verdicts, slim["host"] == verdicts["of_host"], "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("ruled", F.when(F.col("bad"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        F.least(F.coalesce("trust", F.lit(0)), F.lit(2**63 - 1)).cast("long").alias("trust"),
        F.least(F.coalesce("distrust", F.lit(0)), F.lit(2**63 - 1)).cast("long").alias("distrust"),
    )


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages").select("page_id", "url", "html"))

"""URL filtering by rules, and by trust that spreads over the links between hosts.

Rules name a host with all its subdomains and the beginning of a path; the longest that fits decides. For other pages
the host decides: trust starts at hosts whose pages the rules mostly allow and follows links forward, distrust starts at
hosts whose pages they mostly block and follows links backward (who links to blocked hosts is suspect). Both are
personalised PageRank, as the sum of its walks, the seeds of each kind adding up to one: each round moves what is left
along the links, weakened by `damping`, until of either kind less than `rest` is on its way and no host is reached anew. A host with more distrust than trust is blocked; without evidence it is allowed.

Links are counted per pair of hosts before the shuffle, so pages of a hot host are one row per linked host; ranks are
one row per host. A host with very many links is split by the adaptive skew join, as are the pages of a hot host when
they get their host's verdict. Each round is written to shared scratch; the driver sees two numbers a round.

Defined results: a null url, or one without `://`, has empty host and path and is allowed; null html has no links;
repeated rows are judged each; null ids are returned; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import own, stored

DAMPING = 0.85
REST = 1e-3
#: Rounds whose ranks are added up and written, so that the plan does not grow with the longest chain of hosts.
FOLDED = 8


@dataclass(frozen=True)
class Rule:
    verdict: str
    text: str  # host and path, like example.net/en/

    def fits(self) -> Column:
        host, slash, path = self.text.partition("/")
        of_host = (F.col("host") == host) | F.col("host").endswith(f".{host}")
        return of_host & F.col("path").startswith(slash + path)


RULES = (Rule("block", "net/"), Rule("allow", "example.net/en/"), Rule("block", "example.com/de/"), Rule("allow", "org/fr/"))

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Targets of links that name a host, with or without a scheme.
LINK = r"""(?i)\bhref\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s>]+)"""


def parsed(pages: DataFrame, rules: tuple[Rule, ...], *more: str) -> DataFrame:
    """page_id, host, path, and the rule that decides with its verdict."""
    url = F.coalesce("url", F.lit(""))
    cut = own(pages, "page_id", "url", *more).select(
        "page_id",
        F.translate(F.regexp_extract(url, "://([^/?#]*)", 1), _UPPER, _LOWER).alias("host"),
        F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1).alias("path"),
        *more,
    )
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.text)):
        rule = F.when(r.fits(), r.text).otherwise(rule)
        verdict = F.when(r.fits(), r.verdict).otherwise(verdict)
    return cut.withColumns({"rule": rule, "ruled": verdict})


def host_links(pages: DataFrame) -> DataFrame:
    """`src, dst, pages`: how many pages of one host link to another."""
    linked = F.array_distinct(F.transform(F.regexp_extract_all("html", F.lit(LINK), F.lit(1)), lambda x: F.translate(x, _UPPER, _LOWER)))
    links = pages.filter("host <> ''").select(F.col("host").alias("src"), F.explode(linked).alias("dst"))
    return links.filter("src <> dst").groupBy("src", "dst").agg(F.count("*").alias("pages"))


def spread(seeds: DataFrame, links: DataFrame, damping: float = DAMPING, rest: float = REST) -> DataFrame:
    """`kind, host, rank`: where walks from the seeds (`kind, host, rank`) along the links of their kind come to rest.

    `links` has `kind, src, dst, share`; the shares of a source add up to one. Walks that find no link begin anew at a
    seed, which only scales the ranks; those of a kind are scaled to add up to one.
    """
    sums = seeds.groupBy("kind").agg(F.sum("rank").alias("all"))
    step = seeds.join(F.broadcast(sums), "kind").select("kind", "host", (F.col("rank") / F.col("all")).alias("rank"))
    step = stored(step, "walk")
    total, sent, folded = step, step, 0
    while True:
        moved = sent.join(links, (sent["kind"] == links["kind"]) & (sent["host"] == links["src"]))
        moved = moved.groupBy(sent["kind"], F.col("dst").alias("host")).agg(F.sum(F.col("rank") * F.col("share") * damping).alias("rank"))
        sent = stored(moved, "walk")
        left = [r["rank"] for r in sent.groupBy("kind").agg(F.sum("rank").alias("rank")).collect()]  # two rows at most
        spent = max(left, default=0.0) <= rest and sent.join(total, ["kind", "host"], "left_anti").isEmpty()
        if left:
            total, folded = total.unionByName(sent), folded + 1
        if spent:
            break
        if folded == FOLDED:
            total, folded = stored(total.groupBy("kind", "host").agg(F.sum("rank").alias("rank")), "ranks"), 0
    ranks = total.groupBy("kind", "host").agg(F.sum("rank").alias("rank"))
    sums = ranks.groupBy("kind").agg(F.sum("rank").alias("all"))  # two rows at most
    return ranks.join(F.broadcast(sums), "kind").select("kind", "host", (F.col("rank") / F.col("all")).alias("rank"))


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, and the host's trust and distrust."""
    hosts = parsed(pages, rules, "html")
    links = stored(host_links(hosts), "host-links")
    both = links.select(F.lit("trust").alias("kind"), "src", "dst", "pages").unionByName(
        links.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "pages")
    )
    out = both.groupBy(F.col("kind").alias("k"), F.col("src").alias("s")).agg(F.sum("pages").alias("out"))
    shares = both.join(out, (both["kind"] == out["k"]) & (both["src"] == out["s"]))
    shares = stored(shares.select("kind", "src", "dst", (F.col("pages") / F.col("out")).alias("share")), "link-shares")
    judged = parsed(pages, rules)
    count = judged.filter("host <> ''").groupBy("host").agg(
        F.count("*").alias("n"), *[F.count(F.when(F.col("ruled") == v, 1)).alias(v) for v in ("allow", "block")]
    )
    kind = F.when(2 * F.col("allow") > F.col("n"), "trust").when(2 * F.col("block") > F.col("n"), "distrust")
    seeds = count.select(kind.alias("kind"), "host", F.lit(1.0).alias("rank")).filter("kind is not null")
    ranks = spread(seeds, shares)
    side = {name: F.sum(F.when(F.col("kind") == name, F.col("rank")).otherwise(0.0)).alias(name) for name in ("trust", "distrust")}
    by_host = ranks.groupBy("host").agg(*side.values())
    joined = judged.join(by_host, "host", "left").na.fill(0.0, ["trust", "distrust"])
    method = F.when(F.col("distrust") > F.col("trust"), "block").otherwise("allow")
    return joined.select("page_id", "host", "path", "rule", F.coalesce("ruled", method).alias("verdict"), "trust", "distrust")

"""URL filter: rules, and for urls without one, trust and distrust spread over the host graph.

Hosts are seeds in proportion to their pages that a rule allows or blocks. Trust is a personalised
PageRank from allowed seeds along links; distrust is one from blocked seeds against them: who links
to a blocked host is suspect. A host is blocked where its distrust reaches the threshold and exceeds its trust. Links
are counted per pair of hosts before anything is shuffled, so a host with very many pages is one row per task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import ascii_lower, pick, query, table
from ledgerloom.sources.staging import stage


@dataclass(frozen=True)
class Rule:
    """A host with its subdomains and the start of a path."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: The rules of the registered query.
RULES = (
    Rule("net", "/", "block"), Rule("example.net", "/en/", "allow"),
    Rule("example.com", "/de/", "block"), Rule("org", "/fr/", "allow"),
)
#: Share of a host's score that is handed on, the least distrust that blocks, and when rounds end.
DAMPING, THRESHOLD, CLOSE, ROUNDS_AT_ONCE = 0.85, 0.25, 1e-4, 5
_LINK = r"(?i)<a\s[^>]*?href\s*=\s*[\"']?\s*([^\"'\s>]+)"
_TRUST, _DISTRUST = 0, 1


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def url_host(url: Column) -> Column:
    """What follows the first "://" up to "/", "?", "#" or the end, A-Z lower-cased; else empty."""
    return ascii_lower(F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), F.lit("")))


def url_path(url: Column) -> Column:
    """What follows the host up to "?", "#" or the end."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_columns(host: Column, path: Column, rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, null without one."""
    text = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        text = F.when(fits, F.lit(rule.text)).otherwise(text)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return text, verdict


def host_links(pages: DataFrame) -> DataFrame:
    """(source, target, n) of the links of pages (host, html); a link without a host stays on its own."""
    link = F.col("link")
    absolute = link.contains("://") | link.startswith("//")
    other = F.lower(link).rlike(r"^[a-z][a-z0-9+.-]*:") & ~link.contains("://")
    target = F.when(absolute, url_host(F.when(link.startswith("//"), F.concat(F.lit("http:"), link)).otherwise(link))).otherwise(F.col("host"))
    return (
        pages.where("host <> ''").select("host", F.explode(F.regexp_extract_all("html", F.lit(_LINK), F.lit(1))).alias("link"))
        .where(~other).select(F.col("host").alias("source"), target.alias("target")).where("target <> ''")
        .groupBy("source", "target").agg(F.count(F.lit(1)).cast("double").alias("n"))
    )


def host_scores(links: DataFrame, seeds: DataFrame) -> DataFrame:
    """(host, trust, distrust) from links (source, target, n) and seeds (host, allowed, blocked: shares from 0 to 1).

    Hosts without links keep their seed's score. Rounds end when no score moves by more than CLOSE.
    """
    links = stage(links, "host-links")
    hosts = seeds.select("host").union(links.select("source")).union(links.select("target")).distinct()
    known = hosts.join(seeds, "host", "left")
    nodes = stage(
        known.select("host", F.lit(_TRUST).alias("side"), F.coalesce("allowed", F.lit(0.0)).alias("seed"))
        .union(known.select("host", F.lit(_DISTRUST), F.coalesce("blocked", F.lit(0.0)))), "host-seeds",
    )
    out = links.groupBy("source").agg(F.sum("n").alias("all"))
    into = links.groupBy("target").agg(F.sum("n").alias("all"))
    # a host without links on a side keeps what it has there, as if it linked to itself
    moves = links.join(out, "source").select(
        F.lit(_TRUST).alias("side"), F.col("source").alias("host"), F.col("target").alias("to"), (F.col("n") / F.col("all")).alias("share")
    ).union(links.join(into, "target").select(
        F.lit(_DISTRUST), F.col("target"), F.col("source"), F.col("n") / F.col("all")
    ))
    kept = nodes.join(moves.select("side", "host").distinct(), ["side", "host"], "left_anti").select(
        "side", "host", F.col("host").alias("to"), F.lit(1.0).alias("share")
    )
    moves = stage(moves.union(kept), "host-moves")
    score = stage(nodes.select("side", "host", F.col("seed").alias("score")), "host-scores")
    while True:
        before = score
        for _ in range(ROUNDS_AT_ONCE):
            got = score.join(moves, ["side", "host"]).groupBy("side", F.col("to").alias("host")).agg(
                F.sum(F.col("score") * F.col("share")).alias("got")
            )
            score = nodes.join(got, ["side", "host"], "left").select(
                "side", "host", (F.col("seed") * (1 - DAMPING) + F.coalesce("got", F.lit(0.0)) * DAMPING).alias("score")
            )
        score = stage(score, "host-scores")
        moved = score.join(before.withColumnRenamed("score", "old"), ["side", "host"]).agg(F.max(F.abs(F.col("score") - F.col("old")))).first()[0]
        if moved is None or moved <= CLOSE:
            break  # what moves in all shrinks by DAMPING a round, so this comes
    side = F.col("side")
    return score.groupBy("host").agg(
        F.max(F.when(side == _TRUST, F.col("score"))).alias("trust"), F.max(F.when(side == _DISTRUST, F.col("score"))).alias("distrust")
    )


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
          threshold: float = THRESHOLD) -> DataFrame:
    """(id, host, path, rule, verdict, trust, distrust) of every input row.

    The verdict is the longest fitting rule's, else that of the host's scores. A null url or one
    without "://" has an empty host and path, no scores, and is allowed. Null pages have no links.
    """
    named = pick(pages, id=id_col, url=url_col, html=html_col).select(
        "id", "html", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path")
    )
    text, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    judged = named.select("id", "html", "host", "path", text.alias("rule"), verdict.alias("ruled"))
    seeds = judged.where("host <> ''").groupBy("host").agg(
        F.avg((F.coalesce("ruled", F.lit("")) == "allow").cast("double")).alias("allowed"),
        F.avg((F.coalesce("ruled", F.lit("")) == "block").cast("double")).alias("blocked"),
    )
    scores = host_scores(host_links(judged), seeds)
    bad = (F.col("distrust") >= threshold) & (F.col("distrust") > F.col("trust"))
    return judged.drop("html").join(scores, "host", "left").select(
        "id", "host", "path", "rule",
        F.coalesce("ruled", F.when(bad, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"), "trust", "distrust",
    )


@query("op1_url_trust")
def op1(spark: SparkSession, root: str) -> DataFrame:
    """Every page's host, path, rule and verdict, with its host's scores."""
    return judge(table(spark, root, "pages")).withColumnRenamed("id", "page_id")

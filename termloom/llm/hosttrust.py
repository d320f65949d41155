"""URL filters by rules and by trust that flows over the graph of hosts.

Rules decide the URLs they fit.  Every other URL is judged by its host: personalised
PageRank spreads trust from hosts with allowed pages along links, and distrust from hosts
with blocked pages against them, since linking to a bad host is a bad sign.  An edge
goes from a page's host to every host its links name, weighted by the number of pages, and
between a host and its parent domain in both directions.  All of it is DataFrame work.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.session import delete_path, stage, stage_at

#: (list, host, path prefix)
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
DAMPING = 0.85
#: Ranks are settled when none changes by more in a round; so many rounds without that are an error.
TOLERANCE = 1e-6
ROUNDS = 500
#: Rounds in one job; hosts whose ranks are sent to all executors; hosts in one file of ranks.
TOGETHER, NEAR_HOSTS, FILE_HOSTS = 4, 200_000, 500_000
#: A host is blocked when its distrust exceeds its trust by this share of both.
THRESHOLD = 0.0
LINK = r"""(?i)<a\s[^>]*?href\s*=\s*["']?\s*[a-z][a-z0-9+.-]*://([^/?#"'\s>]+)"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#``, A-Z lower-cased; else empty."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    return F.coalesce(lower_ascii(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?`` or ``#``; empty without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    return F.coalesce(F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))


@dataclass(frozen=True)
class Rules:
    """A bounded list of rules; the longest that fits a URL decides it."""

    rows: tuple[tuple[str, str, str], ...] = RULES

    def _longest(self, host: Column, path: Column, value) -> Column:
        found = F.lit(None).cast("string")
        # Shortest first, so that the longest is the outermost test.
        for row in sorted(self.rows, key=lambda r: (len(r[1]) + len(r[2]), r)):
            fits = ((host == row[1]) | host.endswith("." + row[1])) & path.startswith(row[2])
            found = F.when(fits, F.lit(value(row))).otherwise(found)
        return found

    def rule(self, host: Column, path: Column) -> Column:
        return self._longest(host, path, lambda r: r[1] + r[2])

    def verdict(self, host: Column, path: Column) -> Column:
        return self._longest(host, path, lambda r: r[0])


def parent_of(host: Column) -> Column:
    """The domain above a host; null for a name without a dot."""
    return F.when(F.instr(host, ".") > 0, F.regexp_replace(host, r"^[^.]*\.", ""))


def host_edges(pages: DataFrame) -> DataFrame:
    """(source, target, n) between different hosts: links in pages and steps to the parent.

    ``pages`` has host and html.
    """
    links = F.array_distinct(F.transform(F.regexp_extract_all("html", F.lit(LINK), 1), lower_ascii))
    named = pages.filter(F.col("html").contains("://")).select(
        F.col("host").alias("source"), F.explode(links).alias("target")
    )
    linked = named.groupBy("source", "target").agg(F.count("*").cast("double").alias("n"))
    hosts = pages.select("host").union(linked.select("target")).distinct().filter("host <> ''")
    # A host's parents: as many as it has dots.
    parts = F.split("host", r"\.")
    names = F.transform(
        F.sequence(F.lit(1), F.size(parts)),
        lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."),
    )
    chain = hosts.select(F.explode(names).alias("source")).distinct()
    up = chain.select("source", parent_of(F.col("source")).alias("target")).filter("target is not null")
    family = up.union(up.select(F.col("target"), F.col("source"))).withColumn("n", F.lit(1.0))
    every = linked.filter("source <> '' and target <> ''").union(family).filter("source <> target")
    return every.groupBy("source", "target").agg(F.sum("n").alias("n"))


def personal_rank(
    edges: DataFrame, seeds: DataFrame, rounds: int = ROUNDS, damping: float = DAMPING, by: tuple[str, ...] = ()
) -> DataFrame:
    """(host, rank) of PageRank whose jumps go to ``seeds`` (host, weight).

    ``edges`` is (source, target, share), shares of a source summing to one.  Ranks are
    sums of weights, not shares of a whole: what a host gets does not shrink as others come.
    ``by`` names columns of both that keep several graphs apart, which then go on together.
    A job makes ``TOGETHER`` rounds and one table, and the table before it is deleted.
    Rounds go on until no rank has changed by more than ``TOLERANCE`` in such a job.
    """
    spark = edges.sparkSession
    keys = [*by, "host"]
    start = stage(seeds.select(*keys, F.col("weight").alias("jump")).filter("jump > 0"), "host-seeds")
    rank, size = start.select(*keys, F.col("jump").alias("rank")), start.count()
    back = start.select(*keys, (F.col("jump") * (1 - damping)).alias("rank"))
    none, moved, path = F.lit(0.0).alias("old"), 0.0, None
    for _ in range(0, rounds, TOGETHER):
        after = rank
        for _ in range(TOGETHER):
            near = after.withColumnRenamed("host", "source")
            near = F.broadcast(near) if size <= NEAR_HOSTS else near
            sent = edges.join(near, [*by, "source"]).select(
                *by, F.col("target").alias("host"), (F.col("rank") * F.col("share") * damping).alias("rank")
            )
            # Rounded, so that sums do not depend on the order of tasks.
            total = sent.union(back).groupBy(*keys).agg(F.round(F.sum("rank"), 12).alias("rank"))
            after = total.coalesce(max(1, size // FILE_HOSTS + 1))
        both = after.select(*keys, "rank", none).union(rank.select(*keys, F.lit(0.0), F.col("rank")))
        table = both.groupBy(*keys).agg(F.sum("rank").alias("rank"), F.sum("old").alias("old"))
        after, at = stage_at(table.coalesce(max(1, size // FILE_HOSTS + 1)), "host-rank")
        seen = after.agg(F.max(F.abs(F.col("rank") - F.col("old"))).alias("m"), F.count("*").alias("n")).first()
        if path:
            delete_path(spark, path)
        rank, path, moved, size = after.select(*keys, "rank"), at, seen["m"] or 0.0, seen["n"]
        if moved <= TOLERANCE:
            return rank
    raise ValueError(f"ranks still change by {moved} after {rounds} rounds")


def shares(edges: DataFrame, *by: str) -> DataFrame:
    out = edges.groupBy(*by, "source").agg(F.sum("n").alias("out"))
    return edges.join(out, [*by, "source"]).select(
        *by, "source", "target", (F.col("n") / F.col("out")).alias("share")
    )


def judge_pages(pages: DataFrame, rules: Rules | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust) of every row of (page_id, url, html).

    A URL that a rule fits has the rule's verdict, any other its host's: blocked when
    (distrust - trust) > threshold * (distrust + trust).  Hosts that no seed reaches, and
    the empty host of null and odd URLs, have neither and are allowed.  Null html has no
    links; repeated rows count as pages each; extra columns are ignored.
    """
    rules = rules or Rules()
    url = F.col("url").cast("string")
    parsed = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"),
        F.col("html").cast("string").alias("html"),
    ).select("*", rules.rule(F.col("host"), F.col("path")).alias("rule"),
             rules.verdict(F.col("host"), F.col("path")).alias("given"))
    slim = parsed.select("page_id", "host", "path", "rule", "given")
    edges = stage(host_edges(parsed.select("host", "html")), "host-edges")
    seeds = stage(
        slim.filter("host <> ''").groupBy("host").agg(
            (F.count(F.when(F.col("given") == "allow", 1)) / F.count("*")).alias("good"),
            (F.count(F.when(F.col("given") == "block", 1)) / F.count("*")).alias("bad"),
        ),
        "host-judged",
    )
    # Distrust goes the other way; both are ranked in the same jobs.
    turned = edges.select(F.lit("bad").alias("way"), F.col("target").alias("source"), F.col("source").alias("target"), "n")
    ways = edges.select(F.lit("good").alias("way"), "source", "target", "n").union(turned)
    given = F.inline(F.array(*(F.struct(F.lit(w).alias("way"), F.col(w).alias("weight")) for w in ("good", "bad"))))
    both = personal_rank(stage(shares(ways, "way"), "host-ways"), seeds.select("host", given), by=("way",))
    of_way = {w: F.coalesce(F.sum(F.when(F.col("way") == w, F.col("rank"))), F.lit(0.0)) for w in ("good", "bad")}
    ranks = both.groupBy("host").agg(of_way["good"].alias("trust"), of_way["bad"].alias("distrust"))
    ranks = stage(ranks, "host-trust")
    bad = F.col("distrust") - F.col("trust") > threshold * (F.col("distrust") + F.col("trust"))
    own = F.when(F.coalesce(bad, F.lit(False)), "block").otherwise("allow")
    return slim.join(ranks, "host", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("given", own).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )

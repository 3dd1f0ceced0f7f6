"""URL filter: path rules, then trust and distrust carried over links.

A page's url is first held against rules (``host/path``, allow or block; the
longest that fits wins). Hosts most of whose pages are allowed are trusted
seeds, hosts most of whose pages are blocked are blocked seeds. Trust is
personalised PageRank from the trusted seeds along host edges; distrust is the
same from the blocked seeds along the reversed edges, so that hosts linking to
blocked ones receive it. A page without a rule is blocked where its host's
distrust is above ``margin`` times its trust.

Pages are pre-aggregated to hosts and links to weighted host edges before
anything is iterated. Scores are whole numbers (``UNIT`` for each seed), so sums
do not depend on their order; a round joins scores to edges by host, adds up
partially by target, and is checkpointed. The loop ends when nothing changes
any more: scores start at the seeds' own, never fall and are bounded whole
numbers, so it does end, after some 120 rounds where links run in circles; what
rounds down to nothing is not carried on, so a chain of any length ends by then
too. Host facts are joined to pages by broadcast where the counted number of
hosts is small, else with the host spread over salts.

Defined results: a null url, or one without ``://``, has an empty host and path,
and no rule; an empty host is never blocked by the method; rows that repeat an id
each return a row; an empty table gives no rows; columns other than id, url and
html are ignored; a null html has no links.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, functions as F

from tickspan.session import cut_lineage

#: (rule, action)
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
UNIT = 1_000_000_000
DAMPING = 0.85
MARGIN = 1.0
BROADCAST_HOSTS = 100_000
SALTS = 32
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty if there is none."""
    at = F.instr(url, "://")
    return F.when(F.coalesce(at, F.lit(0)) > 0, F.substring(url, at + 3, F.char_length(url))).otherwise(F.lit(""))


def host_of(rest: Column) -> Column:
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(rest: Column) -> Column:
    return F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def host_rules(hosts: DataFrame, rules) -> DataFrame:
    """``host, rules``: the rules that fit each host (itself or a parent domain)."""
    spark = hosts.sparkSession
    table = spark.createDataFrame([(r.split("/", 1)[0].translate(str.maketrans(UPPER, LOWER)), "/" + r.split("/", 1)[1], r, a)
                                   for r, a in rules], "parent string, prefix string, rule string, action string")
    # Of a host's parent domains, those with as many labels as some rule's: few, however many labels the host has.
    depths = sorted({r.split("/", 1)[0].count(".") + 1 for r, _ in rules})
    parents = F.array_distinct(F.array(*[F.substring_index("host", ".", -d) for d in depths]))
    return (hosts.select("host", F.explode(parents).alias("parent")).join(F.broadcast(table), "parent")
            .groupBy("host").agg(F.collect_list(F.struct(F.length("rule").alias("n"), "rule", "action", "prefix")).alias("rules")))


def with_host(pages: DataFrame, facts: DataFrame) -> DataFrame:
    """Left join of facts by host; small ones are broadcast, others salted."""
    if facts.count() <= BROADCAST_HOSTS:
        return pages.join(F.broadcast(facts), "host", "left")
    salted = facts.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64("path", "id"), F.lit(SALTS)).cast("int")
    return pages.withColumn("_salt", salt).join(salted, ["host", "_salt"], "left").drop("_salt")


def host_edges(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """``src, dst, n``: links from pages of one host to another host."""
    rest = after_scheme(F.col(url_col))
    links = F.regexp_extract_all(F.coalesce(F.col(html_col), F.lit("")),
                                 F.lit(r"(?i)<a\s[^>]*?href\s*=\s*[\"']?((?:https?:)?//[^\"'\s>]+)"), F.lit(1))
    out = pages.select(host_of(rest).alias("src"), F.explode(links).alias("href"))
    out = out.select("src", host_of(after_scheme(F.concat(F.lit("x:"), F.regexp_replace("href", "^(?i)https?:", "")))).alias("dst"))
    return (out.where((F.col("dst") != "") & (F.col("src") != "") & (F.col("src") != F.col("dst")))
            .groupBy("src", "dst").agg(F.count("*").alias("n")))


def propagated(seeds: DataFrame, edges: DataFrame, damping: float = DAMPING, rounds: int | None = None) -> DataFrame:
    """``host, trust, distrust`` of every host that has either. ``seeds``: host,
    trusted (boolean). ``rounds``: None for as many as change anything. Mass at hosts without links goes back to the seeds,
    which only scales the scores, so it is left out."""
    both = edges.select(F.lit(True).alias("trusted"), F.col("src").alias("host"), F.col("dst").alias("to"), "n").unionByName(
        edges.select(F.lit(False).alias("trusted"), F.col("dst").alias("host"), F.col("src").alias("to"), "n"))
    degree = both.groupBy("trusted", "host").agg(F.sum("n").alias("all"))
    part = cut_lineage(both.join(degree, ["trusted", "host"]).select(
        "trusted", "host", "to", (F.lit(damping) * F.col("n") / F.col("all")).alias("part")))
    start = cut_lineage(seeds.select("trusted", "host", F.floor(F.lit(UNIT * (1 - damping))).cast("long").alias("score")))
    now, was = start, None
    for _ in itertools.count() if rounds is None else range(rounds):
        sent = now.join(part, ["trusted", "host"]).select(
            "trusted", F.col("to").alias("host"), F.floor(F.col("score") * F.col("part")).cast("long").alias("score")).where("score > 0")
        now = cut_lineage(start.unionByName(sent).groupBy("trusted", "host").agg(F.sum("score").alias("score")))
        mark = tuple(now.agg(F.count("*"), F.sum("score"), F.sum(F.xxhash64("trusted", "host", "score").cast("decimal(38,0)"))).first())
        if mark == was:
            break
        was = mark
    return now.groupBy("host").agg(F.coalesce(F.sum(F.when(F.col("trusted"), F.col("score"))), F.lit(0)).alias("trust"),
                                   F.coalesce(F.sum(F.when(~F.col("trusted"), F.col("score"))), F.lit(0)).alias("distrust"))


def judged(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
           margin: float = MARGIN, damping: float = DAMPING, rounds: int | None = None) -> DataFrame:
    """One row per page: ``<id>, host, path, rule, verdict, trust, distrust``."""
    src = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"),
                       F.col(html_col).cast("string").alias("html"))
    rest = after_scheme(F.col("url"))
    urls = src.select("id", host_of(rest).alias("host"), path_of(rest).alias("path"))
    fits = cut_lineage(host_rules(urls.select("host").distinct(), rules))
    best = F.array_max(F.filter("rules", lambda r: F.startswith(F.col("path"), r["prefix"])))
    ruled = with_host(urls, fits).withColumn("r", best).select("id", "host", "path", F.col("r.rule").alias("rule"),
                                                               F.col("r.action").alias("action"))
    n = F.count("*")
    hosts = cut_lineage(ruled.where("host <> ''").groupBy("host").agg(
        (2 * F.count(F.when(F.col("action") == "allow", 1)) > n).alias("allowed"),
        (2 * F.count(F.when(F.col("action") == "block", 1)) > n).alias("blocked")).where("allowed or blocked"))
    scores = cut_lineage(propagated(hosts.select("host", F.col("allowed").alias("trusted")),
                                    host_edges(src, "url", "html"), damping, rounds))
    told = with_host(ruled, scores)
    trust, distrust = (F.coalesce(c, F.lit(0)).alias(c) for c in ("trust", "distrust"))
    method = F.when(F.coalesce("distrust", F.lit(0)) > F.lit(margin) * F.coalesce("trust", F.lit(0)), "block").otherwise("allow")
    return told.select(F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("action", method).alias("verdict"),
                       trust, distrust)

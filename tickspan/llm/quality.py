"""Host-level quality rules.

Every document is measured by column expressions. The failures of the base
rules are added up by host; a host's rate is shrunk toward the pooled rate by a
beta prior fitted to all hosts by moments, and a host whose shrunk rate is above
``max_rate`` takes its remaining documents along.

The repeated words come from the document's own array of three-word windows,
hashed to 64 bits and sorted: nothing is exploded or shuffled per word. Hosts
are pre-aggregated; their verdicts are joined back by broadcast where their
counted number is small, else with the host spread over salts.

Defined results: a null text has no words and fails; a null host is a host of
its own; rows that repeat an id each return a row; an empty table gives no rows;
columns other than id, text and host are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tickspan.llm.common import SPACE, stored, text_key
from tickspan.session import cut_lineage

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_RATE = 0.5
BROADCAST_HOSTS = 100_000
SALTS = 32
#: Prior strength where the hosts vary no more than chance would have them.
STRONGEST = 1e6


def let(value: Column, body) -> Column:
    """``body`` of ``value``, which is evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_words(words: Column) -> Column:
    """Number of words inside three-word windows that occur twice or more."""
    def hashed(w):
        return F.when(F.size(w) < 4, F.array().cast("array<bigint>")).otherwise(F.transform(
            F.sequence(F.lit(0), F.size(w) - 3),
            lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))))

    def positions(h):
        return let(F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), lambda s: F.sort_array(
            F.transform(F.filter(s, lambda x, i: F.get(s, i - 1)["h"].eqNullSafe(x["h"])
                                 | F.get(s, i + 1)["h"].eqNullSafe(x["h"])),
                        lambda x: x["i"])))

    def covered(p):
        # A window adds the words that the window before it did not reach.
        return F.aggregate(p, F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
                           lambda a, x: F.struct((a["n"] + F.least(F.lit(3), x - a["last"])).alias("n"), x.alias("last")),
                           lambda a: a["n"])
    return let(words, lambda w: let(hashed(w), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0))
                                    .otherwise(covered(positions(h)))))


def measured(docs: DataFrame, id_col: str, text_col: str, host_col: str, carry: bool = False) -> DataFrame:
    """Counts of every document, stored; ``_key`` is its text's key. With
    ``carry`` the document's own columns are stored beside them, in ``_doc``."""
    own = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc")] if carry else []
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
                      F.col(host_col).cast("string").alias("host"), *own)
    own = ["_doc"] if carry else []
    text = F.coalesce("text", F.lit(""))
    words = F.array_remove(F.split(text, SPACE), "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counts = let(words, lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
        repeated_words(w).cast("long").alias("n_repeat_words")))
    dup = let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))
    out = src.select("id", "host", *own, text_key().alias("_key"), counts.alias("c"),
                     F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"), dup.alias("n_dup_lines"))
    failed = (F.col("c.n_words") < MIN_WORDS) | (100 * F.col("c.n_repeat_words") > MAX_REPEAT_PERCENT * F.col("c.n_words"))
    return stored(out.select("id", "host", *own, "_key", "c.n_words", "c.word_chars", "n_symbols", "n_dup_lines",
                             "c.n_repeat_words", failed.alias("base_failed")), "quality-counts")


def host_rates(counts: DataFrame) -> DataFrame:
    """``host, n, failures, rate``: rates of base failures, shrunk by an
    empirical beta prior (moments of the beta-binomial over all hosts)."""
    hosts = cut_lineage(counts.groupBy("host").agg(F.count("*").alias("n"),
                                                   F.sum(F.col("base_failed").cast("long")).alias("failures")))
    k, n, f, n2, s = hosts.agg(F.count("*"), F.sum("n"), F.sum("failures"), F.sum(F.col("n").cast("double") ** 2),
                               F.sum(F.col("failures").cast("double") ** 2 / F.col("n"))).first()
    mean, strength = (f / n if n else 0.0), STRONGEST
    chance = mean * (1 - mean)
    if chance and k > 1:
        spread = (s - n * mean * mean - (k - 1) * chance) / (chance * max(n - n2 / n - (k - 1), 1.0))
        spread = min(max(spread, 1 / (1 + STRONGEST)), 0.999)
        strength = (1 - spread) / spread
    return hosts.withColumn("rate", (F.col("failures") + F.lit(mean * strength)) / (F.col("n") + F.lit(strength)))


def with_verdicts(counts: DataFrame, max_rate: float) -> DataFrame:
    """The counts with ``host_failed`` and ``kept``."""
    bad = cut_lineage(host_rates(counts).where(F.col("rate") > max_rate)
                      .select(F.xxhash64(F.col("host").isNull(), F.coalesce("host", F.lit(""))).alias("_host")).distinct()
                      .withColumn("_bad", F.lit(True)))
    out = counts.withColumn("_host", F.xxhash64(F.col("host").isNull(), F.coalesce("host", F.lit(""))))
    if bad.count() <= BROADCAST_HOSTS:
        out = out.join(F.broadcast(bad), "_host", "left")
    else:
        salted = bad.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        out = out.withColumn("_salt", F.pmod(F.col("_key"), F.lit(SALTS)).cast("int")).join(salted, ["_host", "_salt"], "left")
    failed = F.coalesce("_bad", F.lit(False))
    return out.withColumns({"host_failed": failed, "kept": ~F.col("base_failed") & ~failed})


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
           max_rate: float = MAX_RATE) -> DataFrame:
    """One row per document: ``<id>``, the counts, ``base_failed, kept,
    host_failed`` and the text's ``_key``."""
    return with_verdicts(measured(docs, id_col, text_col, host_col), max_rate).select(
        F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "host_failed", "_key")


def kept_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                   max_rate: float = MAX_RATE) -> DataFrame:
    """The documents that the rules keep, with all their columns. They are
    stored once beside their counts, so no text is shuffled or sorted to meet
    its verdict; every row is judged by its own host."""
    return (with_verdicts(measured(docs, id_col, text_col, host_col, carry=True), max_rate).where("kept")
            .select(*[F.col("_doc").getField(c).alias(c) for c in docs.columns]))

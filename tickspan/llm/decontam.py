"""Benchmark decontamination by spaced-seed hashing.

Texts are lower-cased and cut into words (runs of letters and digits). Fixed
masks of a few words, some of which skip the word at one position, are hashed at
every word of the items and of the documents and joined. A hit names a document,
an item and the offset between them; the item's words are then compared with the
document's at that offset. A document is contaminated by an item where a window
of at most ``window`` of the item's words (all of them if it is shorter) agrees
in at least ``share`` of its positions.

An item takes the first masks of ``MASKS`` that lose nothing in its window:
``most_equal`` counts the equal words a window can have without any mask fitting,
and masks are added until that is fewer than the rule asks. At a share of 0.8
the first three do for windows of 7 to 9 and of 12 words or more; shorter and
sparser masks are hashed only where the benchmark holds items that need them.

Only hashes are shuffled or looked up; the words of an item and of the candidate
offsets are read once per candidate document. Items' hashes are broadcast up to
a counted number, beyond which the hashes of the documents' words are shuffled.
Equal items are one while searching, so copies of an item cost nothing.

Items of fewer than ``least`` words would be found by chance in clean texts; they
contaminate the documents that consist of the same words, by a join of whole
texts. ``least=1`` seeks them within documents like any other.

Defined results: texts and items without a word match nothing; rows that repeat an id with the same text give one row per item, with
different texts the best; an empty table gives no rows; columns other than id
and text are ignored.
"""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column, DataFrame, functions as F

from tickspan.llm.common import stored, text_key
from tickspan.llm.quality import let
from tickspan.session import cut_lineage

#: From selective to sparse; the last one fits any equal word.
MASKS = ("11111", "110111", "111011", "1111", "11011", "10111", "11101", "111", "11", "1")
LEAST_MASKS = 3
WINDOW = 20
SHARE = 0.8
#: Shorter items are compared with whole documents only.
LEAST_WORDS = 5
#: Hashes of items that are broadcast (16 bytes each in the relation, and as much overhead).
BROADCAST_SEEDS = 1_000_000
#: Contaminated documents (id and text key) that are broadcast; beyond, texts are shuffled to them.
BROADCAST_DOCS = 100_000


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def whole_of(words: Column) -> Column:
    """The same for equal sequences of words."""
    return F.sha2(F.array_join(words, " "), 256)


def most_equal(masks: tuple[str, ...], span: int) -> int:
    """The most equal words of a window of ``span`` words that no mask fits."""
    keep = max(map(len, masks)) - 1
    best = {"": 0}          # the last words, equal or not, and the most equal words so far
    for _ in range(span):
        new = {}
        for tail, n in best.items():
            for bit in "01":
                now = tail + bit
                if any(len(now) >= len(m) and all(c == "0" or x == "1" for c, x in zip(m, now[-len(m):])) for m in masks):
                    continue
                new[now[-keep:]] = max(new.get(now[-keep:], 0), n + int(bit))
        best = new
    return max(best.values())


@functools.lru_cache(maxsize=256)
def masks_of(span: int, share: float = SHARE) -> tuple[str, ...]:
    """The first masks that miss no window of ``span`` words with the share equal."""
    for n in range(LEAST_MASKS, len(MASKS)):
        if most_equal(MASKS[:n], span) < math.ceil(share * span):
            return MASKS[:n]
    return MASKS


def seeds(words: Column, masks: tuple[str, ...]) -> Column:
    """Hashes of all masks at all positions, mask after mask; the masks are
    padded to the same number of positions by nulls."""
    least = min(map(len, masks))

    def of(w, number, mask):
        at = [i for i, c in enumerate(mask) if c == "1"]
        return F.transform(F.sequence(F.lit(0), F.size(w) - least), lambda i: F.when(
            i + (len(mask) - 1) < F.size(w), F.xxhash64(F.lit(number), *[F.get(w, i + k) for k in at])))
    return F.when(F.size(words) < least, F.array().cast("array<bigint>")).otherwise(
        F.concat(*[of(words, n, m) for n, m in enumerate(masks)]))


def seed_rows(df: DataFrame, ids: list[str], words: Column, masks: tuple[str, ...]) -> DataFrame:
    """Rows ``<ids>, seed, at``: the position ``at`` of every hash."""
    least = min(map(len, masks))
    made = df.select(*ids, let(words, lambda w: F.struct((F.size(w) - (least - 1)).alias("n"), seeds(w, masks).alias("s"))).alias("w"))
    rows = made.select(*ids, F.col("w.n").alias("n"), F.posexplode("w.s").alias("p", "seed"))
    return rows.where(F.col("seed").isNotNull()).select(*ids, "seed", F.expr("pmod(p, n)").alias("at"))


def item_seeds(texts: DataFrame, window: int, share: float) -> tuple[DataFrame, tuple[str, ...]]:
    """The seeds of every item by its own masks, and the masks of all."""
    span = F.least(F.size("words"), F.lit(window))
    by_masks = {MASKS[:LEAST_MASKS]: []}
    for r in texts.select(span.alias("span")).distinct().collect():    # at most ``window`` rows
        by_masks.setdefault(masks_of(r.span, share), []).append(r.span)
    rows = [seed_rows(texts.where(span.isin(spans)), ["text_item"], F.col("words"), m) for m, spans in by_masks.items()]
    return functools.reduce(DataFrame.unionByName, rows), max(by_masks, key=len)


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text: str = "text", window: int = WINDOW, share: float = SHARE,
                 least: int = LEAST_WORDS) -> DataFrame:
    """Rows ``<id>, <item>, n_equal, n_window, _key``: the best window of every
    item that contaminates a document."""
    raw = benchmark.select(F.col(item_col).alias("item"), words_of(F.col(item_text).cast("string")).alias("words"))
    items = stored(raw.where(F.size("words") >= 1).withColumn("text_item", whole_of(F.col("words"))), "items")
    texts = cut_lineage(items.where(F.size("words") >= least).groupBy("text_item").agg(F.any_value("words").alias("words")))
    short = items.where(F.size("words") < least).select("text_item").distinct()
    known, masks = item_seeds(texts, window, share)
    known = cut_lineage(known)
    few = known.count() <= BROADCAST_SEEDS
    known = known.withColumnRenamed("at", "item_at")
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).withColumn("_key", text_key())

    found = seed_rows(src, ["id", "_key"], words_of(F.col("text")), masks).join(F.broadcast(known) if few else known, "seed")
    offsets = found.select("id", "_key", "text_item", (F.col("at") - F.col("item_at")).alias("offset")).distinct()
    size = texts.select("text_item", F.size("words").alias("size"))
    offsets = offsets.join(F.broadcast(size) if few else size, "text_item")
    tried = cut_lineage(offsets.groupBy("id", "_key").agg(F.collect_list(F.struct("text_item", "offset", "size")).alias("tries")))

    # The document's words at each offset; positions outside of it are left out of the slice.
    left = tried.withColumnsRenamed({"id": "_id", "_key": "_k"})
    cut = src.join(left, F.col("id").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_k"))).select(
        "id", "_key", F.explode(let(words_of(F.col("text")), lambda w: F.transform("tries", lambda t: F.struct(
            t["text_item"].alias("text_item"), t["offset"].alias("offset"),
            F.slice(w, F.greatest(t["offset"], F.lit(0)) + 1, t["size"]).alias("there"))))).alias("t"))
    both = cut.select("id", "_key", "t.*").join(F.broadcast(texts) if few else texts, "text_item")
    skip = F.greatest(-F.col("offset"), F.lit(0))     # item words before the document's first
    equal = F.transform("words", lambda x, j: (x == F.coalesce(F.get("there", j - skip), F.lit(""))).cast("int"))
    span = F.least(F.size("words"), F.lit(window))
    best = let(equal, lambda e: F.array_max(F.transform(
        F.sequence(F.lit(0), F.size(e) - span), lambda s: F.aggregate(F.slice(e, s + 1, span), F.lit(0), lambda a, x: a + x))))
    hits = (both.select("id", "_key", "text_item", best.alias("n_equal"), span.alias("n_window"))
            .where(F.col("n_equal") >= F.lit(share) * F.col("n_window"))
            .groupBy("id", "_key", "text_item").agg(F.max("n_equal").alias("n_equal"), F.max("n_window").alias("n_window")))
    if not short.isEmpty():
        small = src.select("id", "_key", let(words_of(F.col("text")), lambda w: F.when(F.size(w).between(1, least - 1), F.struct(
            whole_of(w).alias("text_item"), F.size(w).alias("n_equal"), F.size(w).alias("n_window")))).alias("w"))
        hits = hits.unionByName(small.where("w is not null").select("id", "_key", "w.*").distinct().join(short, "text_item"))
    named = hits.join(items.select("text_item", "item"), "text_item")
    return (named.groupBy("id", "item").agg(F.max("n_equal").cast("long").alias("n_equal"),
                                            F.max("n_window").cast("long").alias("n_window"),
                                            F.collect_set("_key").alias("_keys"))
            .withColumnsRenamed({"id": id_col, "item": item_col}))


def clean_documents(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    **rule) -> DataFrame:
    """The documents that no item contaminates, with all their columns."""
    bad = cut_lineage(contaminated(docs, benchmark, id_col, text_col, **rule).select(
        F.col(id_col).alias("_bad_id"), F.explode("_keys").alias("_bad_key")).distinct())
    few = bad.count() <= BROADCAST_DOCS
    cond = F.col(id_col).eqNullSafe(F.col("_bad_id")) & (text_key(text_col) == F.col("_bad_key"))
    return docs.join(F.broadcast(bad) if few else bad.hint("shuffle_hash"), cond, "left_anti")

"""Sharding by rendezvous hashing of stable record keys over weighted shards.

Every shard draws a number from the record's key and its own; the record goes
where ``-ln(u) / weight`` is smallest, so a shard gets its weight's part of the
keys. The draw of a shard does not depend on the others: a new shard takes
records only into itself, one that goes gives up only its own, and a changed
weight moves records only from or to that shard. The law is therefore ``key``:
the key and the set of shards decide alone, not the other rows.

Draws are column expressions over an MD5 digest. Slots number a shard's rows
from 0 without gaps, in the order of the key's digest, the key, the size and the
checksum: rows equal in all of these are counted first, prefix sums are taken
over blocks of digests and over their totals, and what a hot key adds up to is
dealt out in parts. Texts are read once and never shuffled.

Defined results: a null text has one byte (the closing one) and the checksum of
no bytes; a null key draws as the empty string does and stays null; rows that repeat a key share its shard and
have a slot each; an empty table gives no rows; other columns are ignored, but
for ``placed`` and ``write``, which keep them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tickspan.llm.common import stored
from tickspan.llm.packing import running

#: Bits of a draw: what a double holds without rounding.
BITS = 52


def draw(key: Column, salt: str = "") -> Column:
    """A whole number below 2 ** BITS from the key's text."""
    return F.conv(F.substring(F.md5(F.concat(key, F.lit(salt))), 1, BITS // 4), 16, 10).cast("long")


def key_text(keys: Sequence[str]) -> Column:
    """One text of all key columns, none of which runs into the next."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    if len(parts) == 1:
        return parts[0]
    return F.concat(*[F.concat(F.length(p).cast("string"), F.lit("="), p) for p in parts])


def winner(key: Column, weights: Mapping[int, float]) -> Column:
    """The shard of the smallest ``-ln(u) / weight``; equal ones: the smaller number."""
    if not weights or any(not 0 < w < float("inf") for w in weights.values()):
        raise ValueError("shards need positive weights")
    drawn = [F.struct((-F.ln((draw(key, f":{s}") + F.lit(0.5)) / F.lit(float(1 << BITS))) / F.lit(float(w))).alias("cost"),
                      F.lit(int(s)).alias("shard")) for s, w in sorted(weights.items())]
    return F.array_min(F.array(*drawn))["shard"]


def even(n: int) -> dict[int, float]:
    return {s: 1.0 for s in range(n)}


def placed(df: DataFrame, weights: Mapping[int, float], keys: Sequence[str] = ("doc_id",), shard_col: str = "shard") -> DataFrame:
    """``df`` with the shard of every row."""
    return df.withColumn(shard_col, winner(key_text(keys), weights))


def moves(df: DataFrame, before: Mapping[int, float], after: Mapping[int, float], keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``old, new, n_rows``: how many rows each shard of ``before`` gives to each of ``after``."""
    key = key_text(keys)
    return df.select(winner(key, before).alias("old"), winner(key, after).alias("new")).groupBy("old", "new").agg(
        F.count("*").alias("n_rows"))


def write(df: DataFrame, path: str, weights: Mapping[int, float], keys: Sequence[str] = ("doc_id",), files: int = 4,
          shard_col: str = "shard") -> None:
    """Whole rows as Parquet, a folder per shard with about ``files`` files, rows
    dealt to the files by all their key columns and a number of their own."""
    part = F.pmod(F.monotonically_increasing_id(), F.lit(files))
    out = placed(df, weights, keys, shard_col).withColumn("_file", part)
    out = out.repartition(len(weights) * files, shard_col, "_file").drop("_file")
    out.write.partitionBy(shard_col).parquet(path)


def numbered(rows: DataFrame, group: str, order: Sequence[str], block_rows: int = 20_000, part: int = 8192) -> DataFrame:
    """``rows`` with ``slot``: their number within ``group``, from 0, by ``_mark``
    and then ``order``. Equal rows take consecutive slots."""
    rows = stored(rows, "shard-rows")
    bits = min(BITS, max(0, (rows.count() // block_rows).bit_length()))
    every = [c for c in rows.columns]
    counts = rows.groupBy(*every).agg(F.count("*").alias("_n")).withColumn("_block", F.shiftright("_mark", BITS - bits))
    first = stored(running(counts, [group], "_block", ["_mark", *order], "_n", "_at"), "shard-slots")
    # A row that repeats more often than ``part`` is dealt out before its rows are made.
    cuts = F.explode(F.expr(f"sequence(0, _n - 1, bigint({part}))"))
    hot = (first.where(F.col("_n") > part).withColumn("_cut", cuts)
           .select(*every, (F.col("_at") + F.col("_cut")).alias("_at"), F.least(F.lit(part), F.col("_n") - F.col("_cut")).alias("_n"))
           .repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "_mark", "_at"))
    few = first.where(F.col("_n") <= part).select(*every, "_at", "_n")
    return (few.unionByName(hot).select(*every, F.explode(F.expr("sequence(_at, _at + _n - 1)")).alias("slot")))


def shards(docs: DataFrame, n: int = 8, id_col: str = "doc_id", text_col: str = "text",
           weights: Mapping[int, float] | None = None) -> DataFrame:
    """One row per document: ``<id>, size, text_crc32, law, shard, slot,
    grown_shard``; the last is the shard with one more of weight 1 (the next number).

    ``n``: shards of equal weight, unless ``weights`` gives them."""
    weights = dict(weights or even(n))
    text, key = F.col(text_col).cast("string"), key_text([id_col])
    grown = weights | {max(weights) + 1: 1.0}
    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.octet_length(text) + F.lit(1), F.lit(1)).cast("long").alias("size"),
        F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        winner(key, weights).alias("shard"), winner(key, grown).alias("grown_shard"), draw(key).alias("_mark"))
    out = numbered(rows, "shard", ["id", "size", "text_crc32"])
    return out.select(F.col("id").alias(id_col), "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")

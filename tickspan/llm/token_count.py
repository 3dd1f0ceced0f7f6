"""Token counts without encoding any text: pieces are counted once per distinct
pre-token and summed over each document's pre-token frequencies.

A pre-token is a run of spaces and what follows up to the next space. No piece
of the vocabulary holds a space after another character (checked when the model
is loaded), so merges never cross a pre-token's edge and the counts add up to
those of the whole text.

Pre-tokens are shuffled, counted and joined by their text. The most frequent
ones, found per chunk of the input and bounded in number, are counted first and
broadcast, so no text of a frequent word is ever a hot join key; every other
pre-token takes the join. The split changes no result.

Defined results: a null or empty text has no tokens and no bytes; rows that
repeat an id each return a row; an empty table gives no rows; columns other than
id and text are ignored.
"""

from __future__ import annotations

import functools
import re
from collections import Counter

import pandas as pd
import pyarrow as pa
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame, functions as F, types as T

from tickspan.llm.common import stored

MODEL = "piece_bpe_32k.model"
MARK = "▁"          # how the vocabulary writes a space
_RUN = re.compile(" +[^ ]*")


@functools.lru_cache(maxsize=2)
def load(model: str):
    """The processor, and the number of pieces of a lone closing space."""
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(model))
    for i in range(sp.get_piece_size()):
        if MARK in sp.id_to_piece(i).lstrip(MARK):
            raise ValueError(f"{model}: pieces may cross a space, so pre-tokens are not independent")
    return sp, len(sp.encode("a ")) - len(sp.encode("a"))


def pre_tokens(text: str | None) -> Counter:
    """Frequencies of a text's pre-tokens, each without its first space (the
    processor adds one); the empty string is a lone closing space."""
    if not text:
        return Counter()
    if MARK in text:
        text = text.replace(MARK, " ")
    if text[0] == " " or "  " in text:
        return Counter(x[1:] for x in _RUN.findall(" " + text))
    return Counter(text.split(" "))


def with_pieces(distinct: DataFrame, model: str) -> DataFrame:
    @F.pandas_udf("long")
    def pieces(pre: pd.Series) -> pd.Series:
        sp, lone = load(model)
        return pd.Series([lone if not p else len(ids)
                          for p, ids in zip(pre, sp.encode(pre.tolist(), num_threads=1))], dtype="int64")
    return distinct.withColumn("pieces", pieces("pre"))


def frequent(texts: DataFrame, per_chunk: int, chunk: int, most: int) -> DataFrame:
    """At most ``most`` pre-tokens: the ``per_chunk`` most frequent of every
    ``chunk`` distinct ones a task meets, cut at a count that leaves no more."""
    def top(batches):
        seen: Counter = Counter()

        def give():
            best = seen.most_common(per_chunk)
            return pa.RecordBatch.from_arrays([pa.array([p for p, _ in best], pa.string()),
                                               pa.array([n for _, n in best], pa.int64())], names=["pre", "n"])
        for b in batches:
            for t in b.column(0).to_pylist():
                seen.update(pre_tokens(t))
                if len(seen) > chunk:
                    yield give()
                    seen.clear()
        yield give()

    counts = stored(texts.mapInArrow(top, "pre string, n long").groupBy("pre").agg(F.sum("n").alias("n")),
                    "pre-tokens")
    step = F.floor(F.log2("n") * 8)
    least, total = 1 << 62, 0
    for r in counts.groupBy(step.alias("s")).agg(F.count("*").alias("k"), F.min("n").alias("n")).orderBy(F.desc("s")).collect():
        if total + r["k"] > most:     # at most eight steps for each doubling: a few hundred rows
            break
        least, total = r["n"], total + r["k"]
    return counts.where(F.col("n") >= least).select("pre")


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL,
                 limit: int = 4096, per_chunk: int = 1 << 16, chunk: int = 1_000_000,
                 broadcast_most: int = 1 << 18) -> DataFrame:
    """One row per document: ``<id>, n_bytes, n_tokens, over_limit``."""
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    often = with_pieces(frequent(src.select("text"), per_chunk, chunk, broadcast_most), model)
    known = spark.sparkContext.broadcast({r["pre"]: r["pieces"] for r in often.collect()})  # broadcast_most at most

    rest_type = pa.list_(pa.struct([("pre", pa.string()), ("n", pa.int64())]))

    def split(batches):
        pieces = known.value.get
        for b in batches:
            sums, rests = [], []
            for t in b.column("text").to_pylist():
                total, rest = 0, []
                for p, n in pre_tokens(t).items():
                    one = pieces(p)
                    if one is None:
                        rest.append({"pre": p, "n": n})
                    else:
                        total += n * one
                sums.append(total)
                rests.append(rest)
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("n_bytes"), pa.array(sums, pa.int64()),
                                              pa.array(rests, rest_type)], names=["id", "n_bytes", "known", "rest"])

    kind = T.StructType([src.schema["id"], *T._parse_datatype_string(
        "n_bytes long, known long, rest array<struct<pre:string,n:long>>").fields])
    sized = src.withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    parts = stored(sized.mapInArrow(split, kind).withColumn("_row", F.monotonically_increasing_id()), "token-parts")
    # One exchange by pre-token serves both the distinct ones and the join: the
    # aggregate uses every column, so both sides read the same shuffled rows.
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rest = (parts.where("_row is not null").select("_row", F.explode("rest").alias("r")).select("_row", "r.pre", "r.n")
            .where("pre is not null").repartition(partitions, "pre"))
    distinct = rest.groupBy("pre").agg(F.sum("n").alias("_n"), F.min("_row").alias("_first")).where("_n > 0 and _first >= 0")
    pieces = with_pieces(distinct.select("pre"), model)
    sums = rest.join(pieces, "pre").groupBy("_row").agg(F.sum(F.col("n") * F.col("pieces")).alias("more"))
    n = F.col("known") + F.coalesce("more", F.lit(0))
    return (parts.drop("rest").join(sums, "_row", "left")
            .select(F.col("id").alias(id_col), "n_bytes", n.alias("n_tokens"), (n > limit).alias("over_limit")))

"""Mixture-controlled packing: deficit round-robin over source queues.

Every source is a queue of segments (a document cut at multiples of the
sequence length, and stored as such) in a pseudo-random order, fixed for the
input's files. A window grants each queue
its share of the window's tokens; a queue sends segments while its deficit
lasts and carries the rest on. A segment that ends at token ``e`` of its queue
is therefore sent in round ``ceil(e / quantum) - 1``: rounds come from prefix
sums, across partitions, without a loop over windows. The rounds, one after the
other, are the token stream, which is cut into sequences. Only the end of the
stream is short; it is cut into powers of two, so nothing is padded.

Shares default to each source's part of all tokens, so all queues run dry
together. Prefix sums are taken in blocks of hashed documents (and of rounds)
and over the blocks' totals, so a source that holds a third of the rows is
spread like any other.

Defined results: a null or empty text is packed as its end id alone; a null
source is a queue of its own, of source null; rows that repeat an id are packed each; an empty
table gives no pieces; columns other than id, text and source are ignored.
"""

from __future__ import annotations

import functools
import os
import re
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F, types as T
from tokenizers import Tokenizer, pre_tokenizers

from tickspan.llm.common import stored

MODEL = "word_bpe_49k.json"
END_ID = 1


@functools.lru_cache(maxsize=2)
def load(model: str) -> Tokenizer:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")     # tasks are the parallelism
    return Tokenizer.from_file(public_tokenizers.path(model))


class WordIds:
    """Ids of whole texts from a bounded cache of their words, kept for all
    tasks of a worker. The tokenizer lower-cases, drops white space, never joins
    across it and cuts between a letter and a following mark, so a text's ids
    are those of its words, in lower case and apart from their closing marks.

    Texts are split, and their words numbered, by Arrow; only a batch's distinct
    words are looked up. The cache holds two generations of ``most`` words; a
    full one becomes the old one, from which words that are met again come back."""

    _LETTERS = re.compile("[a-zß-öø-ÿÀ-ÖØ-Þ]+\\Z")
    _MARKS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'")

    def __init__(self, model: str, dtype: str, most: int = 450_000):
        self.tok, self.dtype, self.most = load(model), np.dtype(dtype), most
        self.known, self.old = {}, {}
        # Words of small Latin letters need neither the normalizer nor the pattern of the whole tokenizer.
        self.bare = Tokenizer(self.tok.model)
        self.bare.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        for probe in ("the", "été", "straße", "internationalization", "zxqj", "ÿ"):
            if self.ids_of(self.bare, probe) != self.ids_of(self.tok, probe):
                self.bare = self.tok
        vocab = self.tok.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)       # tokens that close a word
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True

    @staticmethod
    def ids_of(tok: Tokenizer, text: str) -> list[int]:
        return tok.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def learn(self, new: list[str]) -> None:
        """Encode words that are in neither generation."""
        known, letters, odd, marked, latin = self.known, set(), set(), [], self._LETTERS.match
        for w in new:
            if w.isalpha():
                (letters if w.isascii() or latin(w) else odd).add(w)
                continue
            stem = w.rstrip(self._MARKS)
            if len(stem) < len(w) and stem.isalpha() and (stem.isascii() or latin(stem)):
                marked.append((w, stem, w[len(stem):]))
            else:
                odd.add(w)
        letters.update(m[1] for m in marked if m[1] not in known)
        odd.update(m[2] for m in marked if m[2] not in known)
        # Words of letters alone are encoded as one text and cut where a token closes a word.
        every = list(letters)
        for part in range(0, len(every), 2000):
            some = every[part:part + 2000]
            ids = np.array(self.ids_of(self.bare, " ".join(some).lower()))
            cuts = ((np.flatnonzero(self.ends[ids]) + 1) * self.dtype.itemsize).tolist()
            if len(cuts) == len(some):
                data = ids.astype(self.dtype).tobytes()
                known.update(zip(some, map(data.__getitem__, map(slice, [0, *cuts], cuts))))
            else:
                odd.update(some)
        every = list(odd)
        for part in range(0, len(every), 2000):
            some = every[part:part + 2000]
            for w, e in zip(some, self.tok.encode_batch_fast(some, add_special_tokens=False)):
                known[w] = np.array(e.ids, self.dtype).tobytes()
        known.update((w, known[stem] + known[mark]) for w, stem, mark in marked)

    def lookup(self, words: list[str]) -> list[bytes]:
        pieces = list(map(self.known.get, words))
        if None not in pieces:
            return pieces
        missing = [w for w, p in zip(words, pieces) if p is None]
        if len(self.known) + len(missing) > self.most:
            self.old, self.known = self.known, {}
        known, old = self.known, self.old.get
        new = []
        for w in missing:
            ids = old(w)
            if ids is None:
                new.append(w)
            else:
                known[w] = ids
        if new:
            self.learn(new)
        return [known[w] if p is None else p for w, p in zip(words, pieces)]

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in turn, and where each text's ids start (and the end)."""
        texts = pc.fill_null(texts, "")
        low = pc.ascii_lower(texts)
        special = pc.match_substring(texts, "<|")           # special tokens keep their case
        if pc.any(special).as_py():
            low = pc.if_else(special, texts, low)
        split = pc.ascii_split_whitespace(low)
        words = split.flatten().dictionary_encode()
        pieces = self.lookup(words.dictionary.to_pylist())
        ends = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces))) // self.dtype.itemsize
        each = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()),
                                        pa.array(np.frombuffer(b"".join(pieces), self.dtype)))
        ids = each.take(words.indices)
        at = split.offsets.to_numpy()
        return ids.flatten().to_numpy(zero_copy_only=False), ids.offsets.to_numpy()[at - at[0]]


@functools.lru_cache(maxsize=2)
def word_ids(model: str, dtype: str) -> WordIds:
    return WordIds(model, dtype)


def tokenized(docs: DataFrame, id_col: str, text_col: str, source_col: str, model: str, end_id: int, length: int) -> DataFrame:
    """Stored rows ``id, queue, _row, n, start, ids``, one per segment of
    ``length`` ids of a document (``_row``, of ``n`` ids): little-endian ids, two
    bytes each where the vocabulary allows, with the end id."""
    wide = "<u2" if load(model).get_vocab_size() < 1 << 16 else "<u4"

    def segments(batches):
        ids_of = word_ids(model, wide)
        for whole in batches:
            # Parts of about 8 MB: few enough distinct words, and bounded memory.
            part = np.cumsum(pc.fill_null(pc.binary_length(whole.column("text")), 0).to_numpy()) >> 23
            cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), whole.num_rows]
            for at, end in zip(cuts, cuts[1:]):
                b = whole.slice(at, end - at)
                ids, starts = ids_of(b.column("text"))
                starts = starts.astype(np.int64)
                data = np.insert(ids, starts[1:], end_id).astype(wide)
                starts += np.arange(len(starts))
                n = np.diff(starts)
                many = -(-n // length)
                doc = np.repeat(np.arange(len(n)), many)
                start = (np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)) * length
                edges = np.append(starts[doc] + start, starts[-1])
                blobs = pa.Array.from_buffers(pa.binary(), len(doc), [
                    None, pa.py_buffer((edges * data.itemsize).astype(np.int32)), pa.py_buffer(data)])
                of = pa.array(doc)
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(c).take(of) for c in ("id", "queue", "_row")), pa.array(n[doc]), pa.array(start), blobs],
                    names=["id", "queue", "_row", "n", "start", "ids"])

    def run(batches):
        yield from segments(batches)
        pa.default_memory_pool().release_unused()      # a worker that waits for its next task keeps its words only

    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
                      F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("")).alias("queue"))
    src = src.withColumn("_row", F.monotonically_increasing_id())
    kind = T.StructType([src.schema["id"], *T._parse_datatype_string(
        "queue string, _row long, n long, start long, ids binary").fields])
    return stored(src.mapInArrow(run, kind), "pack-ids")


def running(df: DataFrame, keys: list[str], block: str, order: list, value: str, out: str, group: int = 1024) -> DataFrame:
    """``out``: the sum of ``value`` over earlier rows of the same ``keys``, by
    ``block`` and then ``order``: within blocks, over the totals of ``group``
    blocks, and over the totals of those groups."""
    inside = Window.partitionBy(*keys, block).orderBy(*order)
    sums = df.groupBy(*keys, block).agg(F.sum(value).alias("_t")).withColumn("_g", F.expr(f"{block} div {group}"))
    groups = sums.groupBy(*keys, "_g").agg(F.sum("_t").alias("_gt"))
    all_of = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    groups = groups.withColumn("_gb", F.sum("_gt").over(all_of.orderBy("_g")) - F.col("_gt")).drop("_gt")
    near = Window.partitionBy(*keys, "_g").orderBy(block)
    before = (sums.withColumn("_b", F.sum("_t").over(near) - F.col("_t")).join(groups, [*keys, "_g"])
              .select(*keys, block, (F.col("_b") + F.col("_gb")).alias("_before")))
    return (df.withColumn(out, F.sum(value).over(inside) - F.col(value)).join(before, [*keys, block])
            .withColumn(out, F.col(out) + F.col("_before")).drop("_before"))


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         model: str = MODEL, end_id: int = END_ID, length: int = 2048, window: int = 64,
         shares: dict[str, float] | None = None, block_docs: int = 500, block_rounds: int = 256) -> DataFrame:
    """One row per piece: ``<id>, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, source, round``.

    ``window``: sequences a round fills. ``shares``: wanted part of the tokens
    by source; sources not named share what is left by size, and once a queue
    is empty the others go on."""
    spark = docs.sparkSession
    segments = tokenized(docs, id_col, text_col, source_col, model, end_id, length)
    rows = segments.where("start = 0").select("_row", "id", "queue", "n")
    totals = rows.groupBy("queue").agg(F.sum("n").alias("size"), F.count("*").alias("docs"))
    whole = totals.agg(F.sum("size"), F.sum("docs")).first()
    total, n_docs = int(whole[0] or 0), int(whole[1] or 0)
    wanted = spark.createDataFrame([("=" + s, float(p)) for s, p in (shares or {}).items()], "queue string, want double")
    named = totals.join(F.broadcast(wanted), "queue", "left")
    left = named.agg(F.sum(F.when(F.col("want").isNull(), F.col("size"))), F.sum("want")).first()
    other, taken = float(left[0] or 0), float(left[1] or 0)
    # Named shares and the others' part of the rest; without names, parts of all tokens.
    free = max(0.0, 1.0 - taken) if other else 0.0
    share = F.coalesce(F.col("want") / F.lit(max(taken + free, 1e-12)),
                       F.col("size") * F.lit((free or 1e-6) / max(taken + free, 1e-12) / max(other, 1.0)))
    quantum = named.select("queue", (share * F.lit(float(window * length))).alias("quantum"))

    n_blocks = max(1, -(-n_docs // block_docs))
    # Rows that repeat an id, or have none, take different blocks.
    lens = rows.withColumn("_h", F.xxhash64("id", "_row")).withColumn(
        "_block", F.pmod(F.shiftrightunsigned("_h", 8), F.lit(n_blocks)))
    lens = running(lens, ["queue"], "_block", ["_h", "id", "_row"], "n", "_at")
    sent = (lens.join(quantum, "queue")
            .select("_row", "id", "queue", "n", "quantum", "_at",
                    F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(length).cast("long"))).alias("start"))
            .withColumn("len", F.least(F.lit(length), F.col("n") - F.col("start")))
            .withColumn("_end", F.col("_at") + F.col("start") + F.col("len"))
            .withColumn("round", (F.ceil(F.col("_end") / F.col("quantum")) - 1).cast("long")))
    sent = stored(sent.select("_row", "id", "queue", "n", "start", "len", "_end", "round"), "pack-segments")
    cells = (sent.groupBy("round", "queue").agg(F.sum("len").alias("_size"), F.min(F.col("_end") - F.col("len")).alias("_first"))
             .withColumn("_block", F.expr(f"round div {block_rounds}")))
    cells = running(cells, [], "_block", ["round", F.xxhash64("round", "queue"), "queue"], "_size", "_from")
    at = (sent.join(cells.select("round", "queue", "_first", "_from"), ["round", "queue"])
          .withColumn("_pos", F.col("_from") + F.col("_end") - F.col("len") - F.col("_first")))

    # Bins the piece may fall in: one or two whole sequences, or the powers of two of the short end.
    full, rest = total // length, total % length
    tail, pos = [], 0
    for bit in reversed(range(length.bit_length())):
        if rest >> bit & 1:
            tail.append((full * length + pos, 1 << bit, full + len(tail)))
            pos += 1 << bit
    first, last = F.floor(F.col("_pos") / length), F.floor((F.col("_pos") + F.col("len") - 1) / length)

    def bin_of(k):
        return F.struct((k * length).cast("long").alias("from"), F.lit(length).cast("long").alias("size"), k.cast("long").alias("seq"))
    ends = F.array(*[F.struct(F.lit(a).cast("long").alias("from"), F.lit(b).cast("long").alias("size"),
                              F.lit(c).cast("long").alias("seq")) for a, b, c in tail])
    inner = F.when(first == last, F.array(bin_of(first))).otherwise(F.array(bin_of(first), bin_of(last)))
    bins = F.when(last < full, inner).otherwise(F.concat(F.array(bin_of(first)), ends)) if tail else inner
    lo = F.greatest(F.col("_pos"), F.col("b.from"))
    hi = F.least(F.col("_pos") + F.col("len"), F.col("b.from") + F.col("b.size"))
    pieces = (at.withColumn("b", F.explode(bins)).where((F.col("b.seq") < full) | (F.col("b.size") < length))
              .select("_row", "start", (lo - F.col("_pos")).alias("_skip"), (hi - lo).alias("length"),
                      F.col("b.seq").alias("sequence_id"), (lo - F.col("b.from")).alias("offset"), "round")
              .where(F.col("length") > 0))
    width = 2 if load(model).get_vocab_size() < 1 << 16 else 4
    ids = F.expr(f"substring(ids, int(_skip * {width} + 1), int(length * {width}))")
    joined = pieces.join(segments, ["_row", "start"]).select(
        F.col("id"), (F.col("start") + F.col("_skip")).alias("start"), "length", widened_crc32(ids, width).alias("ids_crc32"), F.col("n").alias("doc_tokens"),
        "sequence_id", "offset", F.expr("if(queue = '', null, substring(queue, 2))").alias("source"), "round")
    return joined.withColumnRenamed("id", id_col)


def widened_crc32(ids, width: int):
    """CRC-32 of the ids as four little-endian bytes each."""
    if width == 4:
        return F.crc32(ids)

    @F.pandas_udf("long")
    def crc(blobs: pd.Series) -> pd.Series:
        return pd.Series([zlib.crc32(np.frombuffer(x, "<u2").astype("<u4").tobytes()) for x in blobs], dtype="int64")
    return crc(ids)

"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most ``radius`` bits have a value between
them that lies within half the radius (rounded up) of one and half the radius
(rounded down) of the other. Every distinct fingerprint emits all variants
within half the radius; the variants are shuffled by value, and fingerprints
that meet at one are candidates. Fingerprints at odd distance differ in parity,
so only even ones need the larger ball.

All members that meet at a variant are within the radius of any member that
lies within the smaller half of it. One such member is the hub and each other
one is linked to it: linear in the members, never all pairs, and no component
changes. Each link is verified by its bit distance.

Defined results: a null or blank text has fingerprint zero and links like any
other; fewer words than a shingle give one shingle of all words; rows that
repeat an id each return a row; a null id is ignored as a component's name, and
a component of null ids alone has a null name; an empty table gives no rows;
columns other than id and text are ignored.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from tickspan.llm.common import connected_components, few_files, stored, text_key
from tickspan.session import cut_lineage

SEED = 42
BITS = 64


def simhash(text: str | None, shingle: int = 3) -> int:
    """Fingerprint of one text as an unsigned integer."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        line = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        hashes = [xxhash.xxh64_intdigest(line[a:b], SEED)
                  for a, b in zip(starts[:len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist())]
    ones = np.zeros(BITS, np.int64)
    values = np.array(hashes, np.uint64)
    for part in range(0, len(values), 1 << 16):   # bounded memory on very long texts
        some = values[part:part + (1 << 16)]
        ones += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(values)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """One row ``id, _key, _fp`` per document: its text's key, and the
    fingerprint's bits as a signed long."""
    def run(batches):
        for b in batches:
            fps = np.fromiter((simhash(t, shingle) for t in b.column(2).to_pylist()), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps.view(np.int64))],
                                             names=["id", "_key", "_fp"])
        pa.default_memory_pool().release_unused()      # a worker that waits for its next task keeps no texts

    src = docs.select(F.col(id_col).alias("id"), text_key(text_col).alias("_key"), F.col(text_col).cast("string").alias("text"))
    out = T.StructType([src.schema["id"], T.StructField("_key", T.LongType()), T.StructField("_fp", T.LongType())])
    return src.mapInArrow(run, out)


def ball(radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Masks to flip, and the number of bits in each, for even fingerprints;
    odd ones use those of at most ``radius // 2`` bits. With radius 3 two of
    the three differing bits lie in the same half of the word, so two-bit masks
    across the halves are not needed."""
    masks, weights = [], []
    for w in range((radius + 1) // 2 + 1):
        for bits in itertools.combinations(range(BITS), w):
            if radius == 3 and w == 2 and bits[0] // 32 != bits[1] // 32:
                continue
            masks.append(sum(1 << b for b in bits))
            weights.append(w)
    return np.array(masks, np.uint64), np.array(weights, np.int64)


#: Variants that a bucket holds (10 bytes each; meeting takes about eight times that).
PER_BUCKET = 1_000_000
#: Fingerprints whose variants are made at a time.
AT_ONCE = 1024


def packed_variants(fps: np.ndarray, masks: np.ndarray, small: int, n_buckets: int) -> pa.RecordBatch:
    """The variants of ``fps``, packed: a row per bucket that gets any."""
    odd = np.bitwise_count(fps) % 2 == 1
    few = masks[:small]
    packed = np.empty(int((~odd).sum()) * len(masks) + int(odd.sum()) * small, entry_of(masks))
    cut = int((~odd).sum()) * len(masks)
    for rows, which, to in ((fps[~odd], masks, packed[:cut]), (fps[odd], few, packed[cut:])):
        to["key"] = (rows[:, None] ^ which[None, :]).ravel()
        to["mask"] = np.tile(np.arange(len(which), dtype=packed.dtype["mask"]), len(rows))
    mixed = packed["key"] * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(32)
    mixed %= np.uint64(n_buckets)
    bucket = mixed.astype(np.int32)
    del mixed
    order = np.argsort(bucket, kind="stable")
    packed, bucket = packed[order], bucket[order]
    del order
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    edges = (np.append(first, len(packed)) * packed.itemsize).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket[first].astype(np.int64)),
         pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(edges), pa.py_buffer(packed)])],
        names=["bucket", "packed"])


def entry_of(masks: np.ndarray) -> np.dtype:
    """A variant: its value and the number of the mask that made it."""
    return np.dtype([("key", "<u8"), ("mask", "<u2" if len(masks) < 1 << 16 else "<u4")])


def meetings(packed, masks: np.ndarray, weights: np.ndarray, radius: int) -> np.ndarray:
    """Distinct pairs ``hub, other`` of fingerprints that meet in a bucket."""
    every = np.concatenate([np.frombuffer(x.as_buffer(), entry_of(masks)) for x in packed])
    keys, which = every["key"].copy(), every["mask"].copy()
    del every
    order = np.argsort(keys, kind="stable")
    keys, which = keys[order], which[order]
    del order
    same = keys[1:] == keys[:-1]
    mine = np.zeros(len(keys), bool)
    mine[1:] |= same
    mine[:-1] |= same
    keys, which = keys[mine], which[mine]
    if not len(keys):
        return np.empty((0, 2), np.uint64)
    fps, near = keys ^ masks[which], weights[which] <= radius // 2
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    group = np.repeat(np.arange(len(starts)), np.diff([*starts, len(keys)]))
    top = np.uint64(0xFFFFFFFFFFFFFFFF)
    hub = np.minimum.reduceat(np.where(near, fps, top), starts)[group]
    has = np.logical_or.reduceat(near, starts)[group]
    ok = has & (fps != hub) & (np.bitwise_count(fps ^ hub) <= radius)
    return np.unique(np.stack([hub[ok], fps[ok]], axis=1), axis=0)


def links(distinct: DataFrame, radius: int = 3, per_bucket: int = PER_BUCKET) -> DataFrame:
    """Links ``a, b`` between the distinct fingerprints in ``_fp``, whose
    components are those of all pairs at ``radius`` bits or fewer.

    Variants travel packed by bucket of their hashed value (8 bytes and a mask
    number), so a bucket holds about ``per_bucket`` of them whatever the data."""
    masks, weights = ball(radius)
    small = int((weights <= radius // 2).sum())
    total = distinct.count() * (len(masks) + small) // 2
    n_buckets = max(1, -(-total // per_bucket), distinct.sparkSession.sparkContext.defaultParallelism if total else 1)

    def emit(batches):
        for b in batches:
            every = np.asarray(b.column(0).to_numpy(zero_copy_only=False)).view(np.uint64)
            for part in range(0, len(every), AT_ONCE):
                yield packed_variants(every[part:part + AT_ONCE], masks, small, n_buckets)
        pa.default_memory_pool().release_unused()

    def meet(table: pa.Table) -> pa.Table:
        pair = meetings(table.column("packed"), masks, weights, radius)
        return pa.table({x: pa.array(pair[:, i].copy().view(np.int64)) for i, x in enumerate("ab")})

    return (distinct.select("_fp").mapInArrow(emit, "bucket long, packed binary")
            .groupBy("bucket").applyInArrow(meet, "a long, b long").distinct())


def classes(docs: DataFrame, id_col: str, text_col: str, shingle: int, radius: int) -> tuple[DataFrame, DataFrame, int]:
    """The stored fingerprints, and ``_fp, _least, _root``: the least id and the
    component of every distinct one, and how many are distinct."""
    fps = stored(fingerprints(docs, id_col, text_col, shingle), "simhash-fps")
    distinct = stored(fps.groupBy("_fp").agg(F.min("id").alias("_least")), "simhash-distinct")
    roots = connected_components(links(distinct, radius))
    n = distinct.count()
    return fps, few_files(distinct.join(roots, distinct["_fp"] == roots["node"], "left").select(
        "_fp", "_least", F.coalesce("root", "_fp").alias("_root")), n), n


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    radius: int = 3) -> DataFrame:
    """One row per document: ``<id>, fingerprint`` (16 hex digits) and
    ``component_id``, the smallest id reachable over links."""
    fps, rooted, n = classes(docs, id_col, text_col, shingle, radius)
    names = few_files(rooted.groupBy("_root").agg(F.min("_least").alias("component_id")), n)
    named = few_files(rooted.join(names, "_root").select("_fp", "component_id"), n)
    return fps.join(named, "_fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                radius: int = 3) -> DataFrame:
    """One document of each component, with all its columns: that of the least
    id (null last) and, where rows share it, the least text key; one of rows
    that are equal in both."""
    fps, rooted, n = classes(docs, id_col, text_col, shingle, radius)
    first = F.struct(F.col("id").isNull().alias("null"), "id", "_key")
    best = cut_lineage(fps.groupBy("_fp").agg(F.min(first).alias("_best")))
    kept = few_files(best.join(rooted, "_fp").groupBy("_root").agg(F.min("_best").alias("b"))
                     .select(F.col("b.id").alias("_kept_id"), F.col("b._key").alias("_kept_key")).distinct(), n)
    same = F.col("id").eqNullSafe(F.col("_kept_id")) & (F.col("_key") == F.col("_kept_key"))
    again = cut_lineage(fps.join(kept, same).groupBy("_kept_id", "_kept_key").count().where("count > 1").drop("count"))

    def of(pairs, how):
        # The pairs are hashed, so the texts are shuffled but not sorted.
        return docs.join(pairs.hint("shuffle_hash"), F.col(id_col).eqNullSafe(F.col("_kept_id")) & (text_key(text_col) == F.col("_kept_key")), how)
    out = of(kept, "left_semi")
    if again.isEmpty():
        return out
    once = kept.join(again.withColumnsRenamed({"_kept_id": "_i", "_kept_key": "_k"}),
                     F.col("_kept_id").eqNullSafe(F.col("_i")) & (F.col("_kept_key") == F.col("_k")), "left_anti")
    return of(once, "left_semi").unionByName(of(again, "left_semi").dropDuplicates([id_col, text_col]))

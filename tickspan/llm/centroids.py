"""Centroid clustering in whole numbers, with bounds that remember the centroids.

Every round assigns each vector to its nearest centroid and replaces the
centroids by their vectors' floored means. A vector keeps the exact distance to
its centroid and, for every group of centroids, a lower bound on the distance to
the others of that group, each with the round in which it was evaluated (Ns-bounds).
All rounds' centroids are kept, so a bound is loosened by the norm of the total
displacement since that round, which is never more than the sum of the norms of
the moves between. Where the bounds leave a doubt, the distance to the own
centroid is evaluated anew, and then all distances to the groups that are still
in doubt, exactly: the result is that of evaluating everything.

A round is one pass that rewrites the vectors with their bounds, as a table in
the shared folder, so a lost executor repeats one part of one round. Only vectors
that changed their cluster add to the next centroids: their differences are
partial sums, one row per centroid at the driver. Centroids of all rounds
(``k`` x ``dims`` x rounds numbers) are all that is sent to tasks.

Defined results: only vectors of exactly ``dims`` components, none null, NaN or
infinite, are kept, others give no row; a null id is kept and its seed text ends
after the colon; rows that repeat an id, or a vector, are vectors each, and equal
seed texts go by the vector; equally near centroids: the smaller number; fewer
vectors than ``k`` give as many centroids; an empty table gives no rows; other
columns are ignored. Components beyond 2 ** 27 in absolute value after scaling are
an error, since squared distances must fit 64 bits.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tickspan.llm.common import stored

LARGEST = 1 << 27
#: Below this, products and their sums are whole numbers that a double holds.
EXACT = 1 << 20
#: Slack for rounding in bounds; a doubt costs an evaluation, never a wrong row.
SLACK = 1e-9


def whole_vectors(df: DataFrame, id_col: str, vector_col: str, dims: int, scale: int) -> DataFrame:
    """``id, v``: kept vectors in whole numbers."""
    e = F.col(vector_col)

    def finite(x: Column) -> Column:
        x = x.cast("double")
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))

    def scaled(x: Column) -> Column:
        y = F.lit(float(scale)) * x.cast("double")
        return F.when(F.abs(y) < F.lit(float(LARGEST)), F.floor(y)).otherwise(
            F.raise_error(F.lit(f"a component is beyond {LARGEST} after scaling"))).cast("int")
    return (df.select(F.col(id_col).alias("id"), e.alias("e")).where(F.coalesce(F.size("e") == dims, F.lit(False)))
            .where(F.forall("e", finite)).select("id", F.transform("e", scaled).alias("v")))


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of ``x`` to all of ``c``."""
    if max(np.abs(x).max(initial=0), np.abs(c).max(initial=0)) <= EXACT:
        a, b = x.astype(float), c.astype(float)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)
    return np.stack([((x - one) ** 2).sum(1) for one in c], 1)


def moved(history: np.ndarray, now: int) -> np.ndarray:
    """By round and centroid, the norm of its displacement from that round to ``now``."""
    return np.sqrt(((history[now][None] - history).astype(float) ** 2).sum(2))


def assigned(x: np.ndarray, state: tuple, history: np.ndarray, now: int, groups: list[np.ndarray]) -> tuple[tuple, np.ndarray]:
    """The state of vectors after round ``now``, and how many distances each took.

    ``state``: cluster, squared distance to it and its round, lower bounds of the
    groups and their rounds; cluster -1 where nothing is known."""
    cluster, dist, seen, lower, since = (s.copy() for s in state)
    c, drift, far = history[now], moved(history, now), np.iinfo(np.int64).max
    most = np.stack([drift[:, g].max(1) for g in groups], 1)                     # by round and group
    every, new = np.arange(len(x)), cluster < 0
    low = np.where(new[:, None], -np.inf, lower - most[since, np.arange(len(groups))])
    upper = np.where(new, 0.0, np.sqrt(dist) + drift[seen, cluster])

    def doubt():
        return low <= (upper * (1 + SLACK) + SLACK)[:, None]

    # The distance to the own centroid first: it may settle the doubt.
    again = every[doubt().any(1) & ~new]
    dist[again], seen[again] = ((x[again] - c[cluster[again]]) ** 2).sum(1), now
    upper[again] = np.sqrt(dist[again])
    work = np.bincount(again, minlength=len(x))
    todo = doubt()
    best, where = np.where(new, far, dist), np.where(new, len(c), cluster)
    scanned = []
    for g, members in enumerate(groups):
        some = every[todo[:, g]]
        d = squared(x[some], c[members])
        scanned.append((some, d))
        work[some] += len(members)
        at = d.argmin(1)
        first, who = d[np.arange(len(some)), at], members[at]
        better = (first < best[some]) | ((first == best[some]) & (who < where[some]))
        best[some[better]], where[some[better]] = first[better], who[better]
    for g, (members, (some, d)) in enumerate(zip(groups, scanned)):
        # A cluster that was left is one of the others of its group from now on.
        left = every[(where != cluster) & ~new & np.isin(cluster, members)]
        lower[left, g], since[left, g] = np.minimum(low[left, g], np.sqrt(dist[left])), now
        others = np.where(members == where[some][:, None], far, d)
        lower[some, g], since[some, g] = np.sqrt(others.min(1, initial=far)), now
    seen[new] = now
    return (where, best, seen, lower, since), work


STATE = "cluster int, was int, distance long, seen int, lower array<double>, since array<int>, work long"


def step(history: np.ndarray, now: int, n_groups: int):
    """Function for ``mapInArrow``: one round over vectors with their state."""
    k, dims = history.shape[1:]
    groups = np.array_split(np.arange(k), min(k, n_groups))

    def flat(b, name, width):
        return b.column(name).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            x = flat(b, "v", dims).astype(np.int64)
            was = b.column("cluster").to_numpy()
            state = (was.astype(np.int64), b.column("distance").to_numpy().astype(np.int64), b.column("seen").to_numpy().astype(np.int64),
                     flat(b, "lower", len(groups)).astype(float), flat(b, "since", len(groups)).astype(np.int64))
            (cluster, dist, seen, lower, since), work = assigned(x, state, history, now, groups)
            at = pa.array(np.arange(b.num_rows + 1) * len(groups), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("v"), pa.array(cluster, pa.int32()), pa.array(was, pa.int32()), pa.array(dist, pa.int64()),
                 pa.array(seen, pa.int32()), pa.ListArray.from_arrays(at, pa.array(lower.ravel())),
                 pa.ListArray.from_arrays(at, pa.array(since.ravel(), pa.int32())),
                 pa.array(b.column("work").to_numpy() + work, pa.int64())],
                names=["id", "v", "cluster", "was", "distance", "seen", "lower", "since", "work"])
    return run


def changes(rows: DataFrame, dims: int) -> DataFrame:
    """One row per centroid that vectors came to or left: ``cluster, n`` and the
    sums of their components, those that left with a minus."""
    signed = F.array(F.struct(F.col("cluster").alias("c"), F.lit(1).cast("long").alias("sign")),
                     F.struct(F.col("was").alias("c"), F.lit(-1).cast("long").alias("sign")))
    return (rows.where("cluster <> was").select("v", F.inline(signed)).where("c >= 0").groupBy("c")
            .agg(F.sum("sign").alias("n"), *[F.sum(F.col("sign") * F.col("v")[i]).alias(f"s{i}") for i in range(dims)]))


def seeds(vectors: DataFrame, k: int, seed: str) -> np.ndarray:
    """The ``k`` vectors with the smallest digests of ``seed:id``."""
    text = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    return np.array([r["v"] for r in vectors.orderBy(text, "v").limit(k).collect()], np.int64)


def rounds_of(vectors: DataFrame, k: int, rounds: int, dims: int, seed: str, n_groups: int) -> tuple[DataFrame, np.ndarray]:
    """Stored rows with their final state, and the centroids of all rounds."""
    start = seeds(vectors, k, seed)
    history = start[None]
    groups = min(len(start), n_groups)
    rows = vectors.selectExpr("id", "v", "-1 AS cluster", "-1 AS was", "0L AS distance", "0 AS seen",
                              f"array_repeat(0D, {groups}) AS lower", f"array_repeat(0, {groups}) AS since", "0L AS work")
    if not len(start):
        return rows, history
    kind = T.StructType([vectors.schema["id"], vectors.schema["v"], *T._parse_datatype_string(STATE).fields])
    sums, sizes = np.zeros(start.shape, np.int64), np.zeros(len(start), np.int64)
    for now in range(rounds + 1):
        rows = stored(rows.mapInArrow(step(history, now, n_groups), kind), "cluster-round")
        if now == rounds:
            break
        for r in changes(rows, dims).collect():        # a row per centroid at most
            sizes[r["c"]] += r["n"]
            sums[r["c"]] += np.array(r[2:], np.int64)
        means = np.where(sizes[:, None] > 0, sums // np.maximum(sizes, 1)[:, None], history[-1])
        history = np.concatenate((history, means[None]))
    return rows, history


def clusters(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 40, rounds: int = 5, dims: int = 64,
             scale: int = 256, seed: str = "2", n_groups: int = 8) -> DataFrame:
    """One row per kept vector: ``<id>, cluster, distance, cluster_inertia,
    inertia, centroid_sha256``. ``n_groups``: lower bounds a vector stores."""
    spark = df.sparkSession
    vectors = stored(whole_vectors(df, id_col, vector_col, dims, scale), "cluster-vectors")
    rows, history = rounds_of(vectors, k, rounds, dims, seed, n_groups)
    if len(history[-1]):
        # Distances of vectors that the bounds settled are as of an earlier round.
        own = spark.createDataFrame([(j, c.tolist(), hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest())
                                     for j, c in enumerate(history[-1])], "cluster int, c array<int>, centroid_sha256 string")
    else:
        own = spark.createDataFrame([], "cluster int, c array<int>, centroid_sha256 string")
    exact = F.aggregate(F.zip_with("v", "c", lambda x, y: (x.cast("long") - y) * (x.cast("long") - y)), F.lit(0).cast("long"),
                        lambda s, x: s + x)
    told = stored(rows.select("id", "v", "cluster").join(F.broadcast(own), "cluster").select(
        "id", "cluster", exact.alias("distance"), "centroid_sha256"), "clusters")
    per = told.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    total = per.agg(F.sum("cluster_inertia").alias("inertia"))
    per = per.withColumn("inertia", F.lit(int(total.first()["inertia"] or 0)).cast("long"))
    return told.join(F.broadcast(per), "cluster").select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia",
                                                         "inertia", "centroid_sha256")

"""Helpers shared by the operators: storage in the shared folder, connected
components, row keys."""

from __future__ import annotations

import os
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickspan.session import cut_lineage, ensure_checkpoint_dir, stored  # noqa: F401 (used by the operators)

#: ASCII white space; a word is a run of anything else.
SPACE = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table; from here on Python workers can import this package as well."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (env.get("PYTHONPATH"), root) if x)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder below the checkpoint folder that driver and executors share."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def text_key(col: str = "text") -> Column:
    """Digest that, with the id, tells apart rows that share an id; rows equal
    in both are the same for every operator here."""
    return F.xxhash64(F.col(col).isNull(), F.coalesce(F.col(col), F.lit("")))


#: Rows that a task contracts at a time, and that a file of a small table holds.
ROWS_AT_ONCE = 1 << 17


def few_files(df: DataFrame, rows: int) -> DataFrame:
    """``df``, of at most ``rows`` narrow rows and made from about as many, checkpointed
    in no more tasks and files than those need: Hadoop's local file system starts some
    processes for every file, and each counts as large as its executor until it runs."""
    return cut_lineage(df.coalesce(max(1, -(-rows // ROWS_AT_ONCE))))


def contracted(edges: DataFrame) -> DataFrame:
    """The edges ``a, b`` with those that a task holds, at most ``ROWS_AT_ONCE`` nodes
    at a time, replaced by one from each node to the least that they connect it to."""
    def stars(up):
        found = pa.RecordBatch.from_arrays([pa.array(list(up), pa.int64()), pa.array([root(up, x) for x in up], pa.int64())], names=["a", "b"])
        up.clear()
        return found

    def root(up, x):
        while (y := up.get(x, x)) != x:
            up[x] = up.get(y, y)
            x = y
        return x

    def run(batches):
        up = {}
        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                a, b = root(up, a), root(up, b)
                if a != b:
                    up[max(a, b)] = min(a, b)
                    if len(up) >= ROWS_AT_ONCE:
                        yield stars(up)
        yield stars(up)

    return edges.select("a", "b").mapInArrow(run, "a long, b long")


def connected_components(edges: DataFrame) -> DataFrame:
    """Components of an undirected graph given as ``a, b`` longs: rows
    ``node, root`` for every node with an edge to another, ``root`` being the
    component's smallest node.

    Edges are contracted within tasks; while that leaves more than stars, large-star
    and small-star steps alternate, so the number of rounds grows with the logarithm
    of the longest path. Every minimum is a partial aggregate and is checkpointed
    before it is joined, so that adaptive execution can split the neighbours of a hot
    node."""
    def shape(e):
        """How many edges, and how many nodes that keep them from being stars."""
        up, down = F.sum("up").alias("up"), F.max("down").alias("down")
        ends = e.selectExpr("a AS node", "1 AS up", "0 AS down").unionByName(e.selectExpr("b AS node", "0 AS up", "1 AS down"))
        row = ends.groupBy("node").agg(up, down).agg(F.sum("up"), F.count_if(F.expr("up > 1 OR up = 1 AND down = 1"))).first()
        return row[0] or 0, row[1]

    e = cut_lineage(contracted(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                               .distinct()))
    rows, tangled = shape(e)
    while tangled:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = few_files(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), 2 * rows)
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        large = few_files(large.distinct(), rows)
        low = few_files(large.groupBy("a").agg(F.min("b").alias("m")), rows)
        small = (large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(low.withColumnRenamed("m", "b")))
        e = cut_lineage(contracted(small.where("a <> b").distinct().coalesce(max(1, -(-rows // ROWS_AT_ONCE)))))
        rows, tangled = shape(e)
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())

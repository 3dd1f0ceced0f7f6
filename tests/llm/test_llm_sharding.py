import collections
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tickspan.llm import oracle, sharding as SH

KIND = "doc_id long, text string, shard string, slot int, size string, id string"


def checked(rows, n):
    """The law, gapless slots, sizes and checksums."""
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert r.law == "key" and 0 <= r.shard < n and r.grown_shard in (r.shard, n)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_odd_rows_and_clashing_columns(spark):
    odd = [(1, None), (2, ""), (3, "é\x00x"), (None, "x"), (None, None), (4, "y" * 50000), (5, "a"), (5, "a"), (5, "b")]
    df = spark.createDataFrame([(i, t, "s", 7, "z", "q") for i, t in odd], KIND).repartition(3)
    got = SH.shards(df, n=3).collect()
    checked(got, 3)
    want = collections.Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in odd)
    assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    assert len({r.shard for r in got if r.doc_id == 5}) == 1
    assert SH.shards(df.limit(0)).collect() == []


def test_a_row_that_repeats_is_dealt_out_in_parts(spark):
    df = spark.range(3000).select(F.when(F.col("id") < 1000, 7).otherwise(F.col("id")).alias("doc_id"), F.lit("t").alias("text"))
    rows = df.select(F.col("doc_id").alias("id"), F.lit(0).alias("shard"), SH.draw(SH.key_text(["doc_id"])).alias("_mark"))
    slots = sorted(r.slot for r in SH.numbered(rows, "shard", ["id"], block_rows=100, part=64).collect())
    assert slots == list(range(3000))
    checked(SH.shards(df).collect(), 8)


def test_a_new_shard_only_takes_and_a_lost_one_only_gives(spark):
    df = spark.range(20000).withColumnRenamed("id", "doc_id")
    eight, nine = SH.even(8), SH.even(9)
    got = {(r.old, r.new): r.n_rows for r in SH.moves(df, eight, nine).collect()}
    assert all(a == b or b == 8 for a, b in got)
    assert abs(sum(n for (a, b), n in got.items() if a != b) - 20000 / 9) < 300
    lost = {s: w for s, w in nine.items() if s != 3}
    got = {(r.old, r.new): r.n_rows for r in SH.moves(df, nine, lost).collect()}
    assert all(a == b or a == 3 for a, b in got)


def test_weights_are_met_and_a_changed_one_moves_only_its_own(spark):
    df = spark.range(40000).withColumnRenamed("id", "doc_id")
    weights = {0: 1.0, 1: 2.0, 5: 5.0}
    n = {r.shard: r["count"] for r in SH.placed(df, weights).groupBy("shard").count().collect()}
    assert all(abs(n[s] - 5000 * w) < 400 for s, w in weights.items())
    got = {(r.old, r.new) for r in SH.moves(df, weights, weights | {1: 3.0}).collect()}
    assert all(a == b or b == 1 for a, b in got)
    for bad in ({}, {0: 0.0}, {0: -1.0}, {0: float("nan")}):
        with pytest.raises(ValueError):
            SH.winner(F.lit("x"), bad)


def test_keys_of_several_columns_do_not_run_into_each_other(spark):
    df = spark.createDataFrame([("a", "bc"), ("ab", "c"), ("", "abc"), (None, "abc")], "x string, y string")
    keys = [r[0] for r in df.select(SH.key_text(["x", "y"])).collect()]
    assert len(set(keys)) == 3


def test_written_shards_hold_every_row(spark, scratch):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    SH.write(docs, f"{scratch}/shards", SH.even(4), files=2)
    back = spark.read.parquet(f"{scratch}/shards")
    want = SH.placed(docs, SH.even(4))
    assert collections.Counter(back.select(*want.columns).collect()) == collections.Counter(want.collect())
    only = spark.read.parquet(f"{scratch}/shards/shard=2")
    assert {r.doc_id for r in only.collect()} == {r.doc_id for r in want.where("shard = 2").collect()}


def test_oracle_on_odd_rows(spark):
    odd = [(1, None), (2, ""), (3, "é x"), (None, "x"), (5, "a"), (5, "a"), (5, "b"), (-7, "z")]
    df = spark.createDataFrame(odd, "doc_id long, text string")
    con = duckdb.connect()
    con.register("pandas_documents", df.toPandas())
    con.execute("CREATE VIEW documents AS SELECT CAST(doc_id AS BIGINT) AS doc_id, text FROM pandas_documents")
    rel = con.sql(oracle.SHARDING)
    got = SH.shards(df).select(*rel.columns).collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter(rel.fetchall())

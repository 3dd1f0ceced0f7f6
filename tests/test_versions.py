import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.helpers import raw, watchlist
from tests.test_json_streaming import DOC_NONE, DOC_NOTE, DOC_OK, _write
from tickspan.operators import watchlist as wl
from tickspan.plans.models import PriceModels
from tickspan.schemas import WATCHLIST
from tickspan.sources import landing, sinks, testfeeds, versions
from tickspan.streaming import ingest


def _models(spark, n):
    items = [("A", f"2024-01-{d:02d}", float(d)) for d in range(2, 2 + n)]
    return PriceModels(raw(spark, items), watchlist(spark, [(1, "a", True)]), calendar=("2024-01-01", "2024-12-31"))


def test_a_reader_keeps_its_rows_over_a_rebuild(spark, scratch):
    root = f"{scratch}/wh"
    names = ["dim_ticker", "fact_stock_price_daily"]
    sinks.materialize(_models(spark, 3), root=root, names=names, versioned=True)
    opened = versions.read(spark, f"{root}/MARTS", "fact_stock_price_daily")
    assert opened.count() == 3
    sinks.materialize(_models(spark, 5), root=root, names=names, versioned=True)
    assert opened.count() == 3 and versions.read(spark, f"{root}/MARTS", "fact_stock_price_daily").count() == 5


def test_a_failed_build_leaves_the_old_version(spark, scratch):
    root = f"{scratch}/wh"
    sinks.materialize(_models(spark, 3), root=root, names=["fact_stock_price_daily"], versioned=True)
    before = versions.current(spark, f"{root}/MARTS")
    broken = _models(spark, 5)
    broken.__dict__["dim_ticker"] = broken.dim_ticker.withColumn("category", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        sinks.materialize(broken, root=root, names=["dim_date", "dim_ticker"], versioned=True, share_intermediates=False)
    assert versions.current(spark, f"{root}/MARTS") == before
    assert versions.read(spark, f"{root}/MARTS", "fact_stock_price_daily").count() == 3


def test_prune_keeps_the_published_version(spark, scratch):
    layer = f"{scratch}/layer"
    for n in range(4):
        versions.replace_table(spark.range(n + 1), layer)
    live = versions.current(spark, layer)
    assert len(versions.versions(spark, layer)) == 4
    assert len(versions.prune(spark, layer, keep=2)) == 2
    assert versions.current(spark, layer) == live and versions.read(spark, layer).count() == 4
    with pytest.raises(FileNotFoundError):
        versions.publish(spark, f"{layer}/v-nothing")
    with pytest.raises(FileNotFoundError):
        versions.current(spark, f"{scratch}/nowhere")


def test_changes_applied_in_place_keep_every_row(spark, scratch):
    from tickspan.__main__ import main
    path = f"{scratch}/watchlist"
    assert main(["seed-watchlist", "--watchlist", path, "--load-ts", "2024-01-01 00:00:00"]) == 0
    for i, (op, symbol) in enumerate([("add", "nvda"), ("deactivate", "SPY"), ("add", "tsla")]):
        wl.make_changes(spark, [(op, symbol)], start=dt.datetime(2024, 2, 1 + i)).write.parquet(f"{scratch}/changes{i}")
        assert main(["apply-changes", "--watchlist", path, "--changes", f"{scratch}/changes{i}", "--out", f"{path}/"]) == 0
    got = {r.symbol: r for r in versions.read(spark, path).collect()}
    assert len(got) == 8 and not got["SPY"].is_active and (got["NVDA"].watchlist_id, got["TSLA"].watchlist_id) == (7, 8)
    # Seeding again adds nothing; the next step reads the published version.
    assert main(["seed-watchlist", "--watchlist", path]) == 0
    assert versions.read(spark, path).count() == 8


def test_a_failed_change_leaves_the_watchlist(spark, scratch):
    path = f"{scratch}/watchlist"
    watchlist(spark, [(1, "A", True), (2, "B", False)]).write.parquet(path)
    bad = spark.read.schema(WATCHLIST).parquet(path).withColumn("notes", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        versions.replace_table(bad, path)
    assert spark.read.schema(WATCHLIST).parquet(f"{path}/part-*").count() == 2 and not versions.is_versioned(spark, path)


def test_versioned_cli_build(spark, scratch):
    from tickspan.__main__ import main
    raw_dir, wl_dir = f"{scratch}/raw", f"{scratch}/wl"
    testfeeds.feed_a_raw_prices(spark, SF_SMALL).write.parquet(raw_dir)
    versions.replace_table(testfeeds.feed_a_watchlist(spark, SF_SMALL), wl_dir)
    assert main(["build", "--raw", raw_dir, "--watchlist", wl_dir, "--out", f"{scratch}/wh", "--versioned"]) == 0
    assert versions.read(spark, f"{scratch}/wh/MARTS", "mart_ticker_performance_summary").count() > 0


def test_a_batch_that_fails_on_its_way_replaces_itself(spark, scratch, monkeypatch):
    path = f"{scratch}/raw"
    rows = raw(spark, [("A", "2024-01-02", 1.0), ("B", "2024-01-02", 2.0)]).repartition(2)
    # The files are in place, the manifest is not: the bookkeeping failed.
    real = landing.write_file

    def fails(*_):
        raise OSError("no bookkeeping")
    monkeypatch.setattr(landing, "write_file", fails)
    with pytest.raises(OSError):
        landing.land(rows, path, "s", 0)
    monkeypatch.setattr(landing, "write_file", real)
    assert landing.land(rows, path, "s", 0) and spark.read.parquet(path).count() == 2
    assert not landing.land(rows, path, "s", 0) and spark.read.parquet(path).count() == 2
    # Other batches, other streams and plain appends add to it.
    assert landing.land(rows, path, "s", 1) and landing.land(rows, path, "t", 0)
    sinks.append_raw(rows, path)
    assert spark.read.parquet(path).count() == 8
    assert landing.land(rows.limit(0), path, "s", 2) and spark.read.parquet(path).count() == 8


def test_a_repeated_stream_batch_lands_once_in_prices_and_rejects(spark, scratch, monkeypatch):
    landed, rawdir, rejdir, ck = (f"{scratch}/{x}" for x in ("landed", "raw", "rejects", "ckpt"))
    _write(f"{landed}/a.json", [DOC_OK, DOC_NOTE, DOC_NONE])
    real, calls = ingest.land, []

    def crash_after_write(batch, path, stream, number):
        real(batch, path, stream, number)
        if path not in calls:
            calls.append(path)
            raise RuntimeError("lost after the write")
    monkeypatch.setattr(ingest, "land", crash_after_write)
    for _ in range(2):
        for q in ingest.ingest_landed(spark, landed, rawdir, rejdir, ck):
            try:
                q.awaitTermination()
            except Exception:
                pass
    assert len(calls) == 2
    assert spark.read.parquet(rawdir).count() == 2 and spark.read.parquet(rejdir).count() == 2


def test_chunks_hold_the_whole_result_in_order(spark):
    df = spark.range(0, 25_000, 1, 5).selectExpr("id AS ID", "cast(id AS decimal(12,2)) AS Price", "if(id % 3 = 0, null, 'x') AS s")
    chunks = list(sinks.fetch_chunks(df, rows=1000))
    assert max(map(len, chunks)) <= 1000 and len(chunks) >= 25
    assert [i for c in chunks for i in c["id"]] == list(range(25_000)) and list(chunks[0].columns) == ["id", "price", "s"]
    assert sum(c["s"].isna().sum() for c in chunks) == 8334
    assert list(sinks.fetch_chunks(df.limit(0))) == []

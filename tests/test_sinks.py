import re
import os

import pytest
from pyspark.sql import functions as F

from tickspan.operators import analytics as an
from tickspan.operators import watchlist as wl
from tickspan.plans.models import MODEL_LAYERS, PriceModels
from tickspan.sources import sinks, testfeeds
from tickspan.sources.starter import starter_tickers
from tests.conftest import SF_SMALL
from tests.helpers import raw, watchlist


def test_layer_routing():
    assert sinks.schema_name("marts", "PUBLIC") == "MARTS"
    assert sinks.schema_name(None, "PUBLIC") == "PUBLIC"


def test_materialize_layers(spark, scratch):
    m = PriceModels(testfeeds.feed_a_raw_prices(spark, SF_SMALL), testfeeds.feed_a_watchlist(spark, SF_SMALL),
                    calendar=("1995-01-01", "2001-12-31"))
    out = sinks.materialize(m, root=f"{scratch}/wh")
    assert set(out) == set(MODEL_LAYERS)
    assert out["stg_market__stock_prices"] == "STAGING__stg_market__stock_prices"
    assert spark.table(out["int_stock_volatility"]).count() == 5334
    summary = spark.read.parquet(out["mart_ticker_performance_summary"])
    assert summary.count() == m.mart_ticker_performance_summary.count()
    assert os.path.isdir(f"{scratch}/wh/MARTS/dim_date")


def test_append_raw_then_restage(spark, scratch):
    batch = raw(spark, [("A", "2024-01-02", 1.0), ("A", "2024-01-03", 2.0)])
    path = f"{scratch}/raw"
    sinks.append_raw(batch, path)
    sinks.append_raw(batch, path)
    back = spark.read.parquet(path)
    assert back.count() == 4
    m = PriceModels(back, watchlist(spark, [(1, "a", True)]), calendar=("2024-01-01", "2024-12-31"))
    assert m.stg_market__stock_prices.count() == 2


def test_fetch_bounded(spark):
    df = spark.range(5).select(F.col("id").alias("ID"))
    pdf = sinks.fetch_bounded(df, 10)
    assert list(pdf.columns) == ["id"] and len(pdf) == 5
    with pytest.raises(ValueError):
        sinks.fetch_bounded(df, 3)


def test_starter_rows_inserted_once(spark):
    empty = spark.createDataFrame([], "watchlist_id bigint, symbol string")
    first = wl.insert_if_absent(empty, starter_tickers(spark), load_ts="2024-01-01")
    assert sorted((r.watchlist_id, r.symbol) for r in first.collect()) == [
        (1, "AAPL"), (2, "ASTS"), (3, "GOOGL"), (4, "JPM"), (5, "MSFT"), (6, "SPY")]
    asts = first.where("symbol = 'ASTS'").first()
    assert asts.notes.startswith(" ") and asts.is_active
    again = wl.insert_if_absent(first, starter_tickers(spark), load_ts="2024-01-02")
    assert again.count() == 0


def test_listing_toggle(spark):
    w = watchlist(spark, [(1, "b", True), (2, "a", False), (3, "c", True)])
    assert [r.symbol for r in an.watchlist_listing(w).collect()] == ["b", "c", "a"]
    assert [r.symbol for r in an.watchlist_listing(w, include_inactive=False).collect()] == ["b", "c"]
    assert [r.symbol for r in an.active_symbols(w).collect()] == ["b", "c"]


def test_shared_intermediates_give_same_marts(spark):
    def build():
        return PriceModels(testfeeds.feed_a_raw_prices(spark, SF_SMALL), testfeeds.feed_a_watchlist(spark, SF_SMALL),
                           calendar=("1995-01-01", "2001-12-31"))
    plain, shared = build(), build()
    shared.share_intermediates()
    for name in ("fact_stock_performance_daily", "mart_watchlist_performance", "mart_ticker_performance_summary"):
        assert sorted(plain.model(name).collect()) == sorted(shared.model(name).collect()), name


def test_facts_read_their_own_columns_of_what_is_shared(spark):
    m = PriceModels(testfeeds.feed_a_raw_prices(spark, SF_SMALL), testfeeds.feed_a_watchlist(spark, SF_SMALL), calendar=None)
    m.share_intermediates()
    plan = m.fact_stock_price_daily._jdf.queryExecution().executedPlan().toString()
    assert "open_price" in plan and "moving_average_50d" not in plan and "Window" not in plan
    assert "trading_date" in re.findall(r"ReadSchema: struct<([^>]*)", plan)[0]


def test_build_then_check_written_tables(spark, scratch):
    from tickspan.plans.build import build
    m = PriceModels(testfeeds.feed_a_raw_prices(spark, SF_SMALL), testfeeds.feed_a_watchlist(spark, SF_SMALL),
                    calendar=("1995-01-01", "2001-12-31"))
    locs, checks = build(m, root=f"{scratch}/wh")
    res = checks.collect()
    assert len(res) == 72 and all(r.failures == 0 for r in res)
    # table models now read the written parquet
    assert "parquet" in m.fact_stock_price_daily._jdf.queryExecution().optimizedPlan().toString().lower()


def test_interactive_changes(spark):
    import datetime as dt
    ch = wl.make_changes(spark, [("add", " nvda ", "Nvidia", "Semis", ""), ("deactivate", "NVDA"),
                                 ("update", "NVDA", "NVIDIA Corp", "", "n")], start=dt.datetime(2024, 1, 1))
    r = wl.apply_changes(ch).first()
    assert (r.symbol, r.is_active, r.company_name, r.category, r.notes) == ("NVDA", False, "NVIDIA Corp", None, "n")
    assert [x.outcome for x in wl.change_outcomes(ch).orderBy("event_id").collect()] == ["added", "deactivated", "updated"]


def test_history_prunes_year_partitions(spark, scratch):
    from tickspan.operators.analytics import ticker_history
    m = PriceModels(testfeeds.feed_a_raw_prices(spark, SF_SMALL), testfeeds.feed_a_watchlist(spark, SF_SMALL),
                    calendar=("1995-01-01", "2001-12-31"))
    locs = sinks.materialize(m, root=f"{scratch}/wh", names=["mart_watchlist_performance"],
                             share_intermediates=False)
    mart = spark.read.parquet(locs["mart_watchlist_performance"])
    h = ticker_history(mart, "90D")
    h.collect()
    plan = h._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(calendar_year" in plan and "calendar_year#" in plan
    want = m.history("90D").collect()
    assert sorted(h.collect()) == sorted(want)


def test_cli_build(spark, scratch):
    from tickspan.__main__ import main
    raw_dir, wl_dir = f"{scratch}/raw", f"{scratch}/wl"
    testfeeds.feed_a_raw_prices(spark, SF_SMALL).write.parquet(raw_dir)
    testfeeds.feed_a_watchlist(spark, SF_SMALL).write.parquet(wl_dir)
    assert main(["build", "--raw", raw_dir, "--watchlist", wl_dir, "--out", f"{scratch}/wh"]) == 0
    assert spark.read.parquet(f"{scratch}/wh/CHECKS").count() == 72
    assert spark.read.parquet(f"{scratch}/wh/MARTS/mart_ticker_performance_summary").count() > 0


def test_cli_watchlist_jobs(spark, scratch):
    import datetime as dt
    from tickspan.__main__ import main
    path = f"{scratch}/watchlist"
    assert main(["seed-watchlist", "--watchlist", path, "--load-ts", "2024-01-01 00:00:00"]) == 0
    assert main(["seed-watchlist", "--watchlist", path, "--load-ts", "2024-01-02 00:00:00"]) == 0
    w = spark.read.parquet(path)
    assert w.count() == 6 and w.where("created_at = timestamp_ntz'2024-01-01 00:00:00'").count() == 6
    ch = wl.make_changes(spark, [("deactivate", "SPY"), ("add", "nvda", "NVIDIA", "Tech", "")],
                         start=dt.datetime(2024, 2, 1))
    ch.write.parquet(f"{scratch}/changes")
    assert main(["apply-changes", "--watchlist", path, "--changes", f"{scratch}/changes",
                 "--out", f"{scratch}/next"]) == 0
    nxt = {r.symbol: r for r in spark.read.parquet(f"{scratch}/next").collect()}
    assert len(nxt) == 7 and not nxt["SPY"].is_active and nxt["NVDA"].watchlist_id == 7


def test_a_year_is_written_by_few_files(spark, scratch, monkeypatch):
    monkeypatch.setattr(sinks, "FILES_PER_PARTITION", 2)
    m = PriceModels(testfeeds.feed_a_raw_prices(spark, SF_SMALL), testfeeds.feed_a_watchlist(spark, SF_SMALL), calendar=None)
    locs = sinks.materialize(m, root=f"{scratch}/wh", names=["mart_watchlist_performance"], share_intermediates=False)
    for year in os.listdir(locs["mart_watchlist_performance"]):
        if year.startswith("calendar_year"):
            files = [f for f in os.listdir(f"{locs['mart_watchlist_performance']}/{year}") if f.endswith(".parquet")]
            assert 1 <= len(files) <= 2


def test_a_missing_watchlist_is_an_error(spark, scratch):
    from tickspan.__main__ import main
    wl.make_changes(spark, [("add", "A", "", "", "")]).write.parquet(f"{scratch}/changes")
    for missing in (f"{scratch}/nowhere", f"file://{scratch}/nowhere"):
        with pytest.raises(FileNotFoundError):
            main(["apply-changes", "--watchlist", missing, "--changes", f"{scratch}/changes", "--out", f"{scratch}/next"])

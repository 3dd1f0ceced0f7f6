import datetime as dt

import pytest

from tickspan.operators import analytics as an
from tickspan.operators.periods import period_definitions
from tickspan.plans.models import PriceModels
from tickspan.sources.holidays import market_holidays
from tickspan.sources.sinks import with_load_defaults
from tests.helpers import raw, watchlist


def _models(spark, items, wl):
    return PriceModels(raw(spark, items), watchlist(spark, wl), market_holidays(spark),
                       calendar=("2023-01-01", "2024-12-31"))


def test_leap_day_one_year_start(spark):
    m = _models(spark, [("A", "2023-03-01", 1.0), ("A", "2024-02-29", 2.0)], [(1, "a", True)])
    defs = {r.period_name: r for r in period_definitions(m.fact_stock_performance_daily).collect()}
    assert defs["1Y"].period_start == dt.date(2023, 2, 28) and defs["1Y"].period_end == dt.date(2024, 2, 29)
    assert defs["MTD"].period_start == dt.date(2024, 2, 1) and defs["30D"].period_start == dt.date(2024, 1, 31)


def test_active_anchor_differs_from_global_anchor(spark):
    items = [("A", "2024-01-02", 1.0), ("A", "2024-01-03", 1.0), ("B", "2024-03-01", 1.0)]
    m = _models(spark, items, [(1, "a", True), (2, "b", False)])
    # summary anchors on all tickers (latest 2024-03-01): A has no 30D row
    s = {(r.ticker_symbol, r.period_name) for r in m.mart_ticker_performance_summary.collect()}
    assert ("A", "30D") not in s and ("B", "30D") in s
    # the page's history anchors on the active mart (latest 2024-01-03): A has 30D history
    h = m.history("30D").collect()
    assert [r.trading_date for r in h] == [dt.date(2024, 1, 2), dt.date(2024, 1, 3)]


def test_signal_edges(spark):
    snap = spark.createDataFrame([
        ("EQ", dt.date(2024, 1, 2), 10.0, 0.03, 10.0, 0.30),
        ("UP", dt.date(2024, 1, 2), 11.0, -0.0301, 10.0, 0.3001),
        ("NA", dt.date(2024, 1, 2), 0.0, None, 10.0, None)],
        "ticker_symbol string, trading_date date, close_price double, daily_return_pct double, "
        "moving_average_20d double, annualized_volatility_20d double")
    got = {r.ticker_symbol: (r.ma20_signal, r.high_volatility, r.unusual_move) for r in an.signals(snap).collect()}
    assert got == {"EQ": ("bearish", False, False), "UP": ("bullish", True, True), "NA": (None, False, False)}


def test_benchmark_series_with_unlike_starts(spark):
    hist = spark.createDataFrame([
        ("T", dt.date(2024, 1, 2), 10.0), ("T", dt.date(2024, 1, 3), 11.0), ("T", dt.date(2024, 1, 4), 12.0),
        ("B", dt.date(2024, 1, 3), 100.0), ("B", dt.date(2024, 1, 4), 150.0)],
        "ticker_symbol string, trading_date date, close_price double")
    got = sorted((r.trading_date.day, r.ticker_cumulative_return_pct, r.benchmark_cumulative_return_pct)
                 for r in an.benchmark_comparison(hist, "B").collect())
    assert got == [(3, pytest.approx(10.0), 0.0), (4, pytest.approx(20.0), 50.0)]


def test_investment_scenario(spark):
    hist = spark.createDataFrame([("T", dt.date(2024, 1, 2), 50.0, 10.0), ("T", dt.date(2024, 1, 3), 60.0, 30.0)],
                                 "ticker_symbol string, trading_date date, close_price double, volume double")
    r = an.investment_scenario(hist).first()
    assert (r.shares, r.end_value, r.gain_loss, r.avg_daily_volume) == (200.0, 12000.0, 2000.0, 20.0)
    assert r.period_return_pct == pytest.approx(20.0)


def test_load_defaults(spark):
    rows = raw(spark, [("A", "2024-01-02", 1.0)]).drop("source", "loaded_at")
    r = with_load_defaults(rows, loaded_at="2024-01-03 06:00:00").first()
    assert r.source == "alpha_vantage" and r.loaded_at == dt.datetime(2024, 1, 3, 6)


def test_point_filter_on_symbol(spark):
    items = [("A", "2024-01-02", 1.0), ("A", "2024-01-03", 2.0), ("B", "2024-01-03", 5.0)]
    m = _models(spark, items, [(1, "a", True), (2, "b", True)])
    h = m.history("ALL_AVAILABLE", symbol="A")
    assert [(r.ticker_symbol, r.close_price) for r in h.collect()] == [("A", 1.0), ("A", 2.0)]
    s = an.ordered_summary(m.mart_ticker_performance_summary, symbol="B").collect()
    assert {r.ticker_symbol for r in s} == {"B"} and [r.period_rank for r in s] == sorted(r.period_rank for r in s)


def test_default_benchmark_is_first_other_symbol(spark):
    hist = spark.createDataFrame([
        ("A", dt.date(2024, 1, 2), 10.0), ("A", dt.date(2024, 1, 3), 20.0),
        ("B", dt.date(2024, 1, 2), 5.0), ("B", dt.date(2024, 1, 3), 6.0),
        ("C", dt.date(2024, 1, 3), 7.0)],
        "ticker_symbol string, trading_date date, close_price double")
    got = sorted((r.ticker_symbol, r.benchmark_symbol, r.trading_date.day) for r in an.benchmark_comparison(hist).collect())
    assert got == [("A", "B", 2), ("A", "B", 3), ("B", "A", 2), ("B", "A", 3), ("C", "A", 3)]

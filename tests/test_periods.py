import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickspan.plans.models import PriceModels
from tickspan.sources import testfeeds
from tickspan.sources.holidays import market_holidays
from tests.conftest import SF_MID
from tests.helpers import raw, watchlist


def _summary(spark, items, wl):
    m = PriceModels(raw(spark, items), watchlist(spark, wl), market_holidays(spark), calendar=("2023-01-01", "2024-12-31"))
    return {(r.ticker_symbol, r.period_name): r for r in m.mart_ticker_performance_summary.collect()}


def test_stopped_ticker_has_no_mtd_and_single_day_period(spark):
    items = [("A", "2024-02-27", 10.0), ("A", "2024-02-28", 11.0), ("A", "2024-02-29", 12.0),
             ("B", "2024-01-30", 5.0), ("B", "2024-01-31", 6.0)]
    s = _summary(spark, items, [(1, "a", True), (2, "b", False)])
    assert ("B", "MTD") not in s and ("B", "YTD") in s  # inactive tickers are kept
    # latest date 2024-02-29 → 1Y starts 2023-02-28
    one = s[("A", "MTD")]
    assert one.trading_days_count == 3 and one.period_start_date == dt.date(2024, 2, 27)
    assert one.period_return_pct == pytest.approx(0.2)
    assert s[("B", "ALL_AVAILABLE")].trading_days_count == 2


def test_one_day_period_return_zero(spark):
    s = _summary(spark, [("A", "2024-01-31", 10.0), ("A", "2024-02-01", 11.0)], [(1, "a", True)])
    r = s[("A", "MTD")]
    assert r.trading_days_count == 1 and r.period_return_pct == 0.0
    assert r.start_close_price == r.end_close_price


def test_feed_a_golden_period_counts(spark):
    m = PriceModels(testfeeds.feed_a_raw_prices(spark, SF_MID), testfeeds.feed_a_watchlist(spark, SF_MID),
                    calendar=("1995-01-01", "2001-12-31"))
    got = {r.period_name: (r.t, r.n) for r in m.mart_ticker_performance_summary.groupBy("period_name").agg(
        F.count(F.lit(1)).alias("t"), F.sum("trading_days_count").alias("n")).collect()}
    assert got == {"ALL_AVAILABLE": (100, 53307), "1Y": (100, 7708), "YTD": (100, 6458),
                   "90D": (100, 1868), "30D": (100, 636), "MTD": (64, 87)}
    perf = m.fact_stock_performance_daily.agg(F.count("daily_return_pct"), F.count("volatility_20d"),
                                              F.round(F.sum("daily_return_pct"), 6)).first()
    assert tuple(perf) == (53207, 53107, 75021.407833)


@pytest.mark.parametrize("latest", ["2024-01-01", "2024-01-31", "2024-02-29", "2024-03-02", "2024-05-15", "2024-12-31"])
def test_nested_cells_give_every_period_its_own_rows(spark, latest):
    """Each period's rows selected on their own, for ends where the starts change their order or coincide."""
    import random

    from tickspan.operators import periods as P
    rnd = random.Random(latest)
    last = dt.date.fromisoformat(latest)
    rows = []
    for t in range(6):
        days = sorted(rnd.sample(range(700), rnd.choice([1, 5, 60])))
        for d in days:
            rows.append((f"T{t}", last - dt.timedelta(days=d + (t == 3) * 40), float(rnd.randint(1, 99)),
                         rnd.choice([None, rnd.random()]), rnd.choice([None, rnd.random()]), rnd.choice([None, rnd.randint(1, 1000)])))
    rows.append(("T9", last, 5.0, None, None, None))
    df = spark.createDataFrame(rows, "ticker_symbol string, trading_date date, close_price double, daily_return_pct double, "
                                     "volatility_20d double, volume bigint")
    names = spark.createDataFrame([(f"T{t}", None, None) for t in range(10)], "ticker_symbol string, company_name string, category string")
    got = {(r.ticker_symbol, r.period_name): r for r in P.period_summary(df, names).collect()}
    first = min(r[1] for r in rows)
    starts = {"ALL_AVAILABLE": first, "YTD": last.replace(month=1, day=1), "MTD": last.replace(day=1),
              "30D": last - dt.timedelta(days=29), "90D": last - dt.timedelta(days=89),
              "1Y": last.replace(year=2023, day=28 if (last.month, last.day) == (2, 29) else last.day)}
    want = {}
    for name, start in starts.items():
        for t in sorted({r[0] for r in rows}):
            own = sorted((r for r in rows if r[0] == t and start <= r[1] <= last), key=lambda r: r[1])
            if own:
                want[t, name] = own
    assert set(got) == set(want)

    def mean(values):
        some = [v for v in values if v is not None]
        return pytest.approx(sum(some) / len(some)) if some else None
    for key, own in want.items():
        r = got[key]
        assert (r.period_start_date, r.period_end_date, r.trading_days_count) == (own[0][1], own[-1][1], len(own)), key
        assert (r.start_close_price, r.end_close_price) == (own[0][2], own[-1][2])
        assert (r.min_close_price, r.max_close_price) == (min(o[2] for o in own), max(o[2] for o in own))
        assert r.avg_daily_return_pct == mean(o[3] for o in own) and r.volatility_pct == mean(o[4] for o in own)
        assert r.avg_volume == mean(o[5] for o in own)


def test_no_price_row_is_multiplied(spark):
    m = PriceModels(testfeeds.feed_a_raw_prices(spark, SF_MID), testfeeds.feed_a_watchlist(spark, SF_MID), calendar=None)
    lines = m.mart_ticker_performance_summary._jdf.queryExecution().optimizedPlan().toString().splitlines()
    made = [i for i, x in enumerate(lines) if "Generate explode" in x]
    cells = [i for i, x in enumerate(lines) if "Aggregate [ticker_symbol" in x and "_cell" in x]
    assert len(made) == 1 and cells and made[0] < cells[0]

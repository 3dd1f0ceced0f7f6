import datetime as dt

from tickspan.plans import staging
from tests.helpers import raw, watchlist


def test_latest_load_wins(spark):
    t = dt.datetime(2024, 1, 3)
    df = raw(spark, [("AAPL", "2024-01-02", 1.0, t), ("AAPL", "2024-01-02", 3.0, t + dt.timedelta(days=2)),
                     ("AAPL", "2024-01-02", 2.0, t + dt.timedelta(days=1)), ("AAPL", "2024-01-03", 5.0, t)])
    got = sorted((r.trading_date.isoformat(), float(r.close_price))
                 for r in staging.stg_stock_prices(df).collect())
    assert got == [("2024-01-02", 3.0), ("2024-01-03", 5.0)]


def test_tie_on_load_time_is_deterministic(spark):
    t = dt.datetime(2024, 1, 3)
    a = raw(spark, [("X", "2024-01-02", 1.0, t), ("X", "2024-01-02", 2.0, t)])
    b = raw(spark, [("X", "2024-01-02", 2.0, t), ("X", "2024-01-02", 1.0, t)]).repartition(3)
    for df in (a, b):
        assert [float(r.close_price) for r in staging.stg_stock_prices(df).collect()] == [2.0]


def test_append_twice_is_idempotent(spark):
    batch = raw(spark, [("A", "2024-01-02", 1.0), ("A", "2024-01-03", 2.0), ("B", "2024-01-02", 3.0)])
    once = staging.stg_stock_prices(batch)
    twice = staging.stg_stock_prices(batch.unionByName(batch))
    assert sorted(once.collect()) == sorted(twice.collect())


def test_symbol_case_is_kept_in_prices_but_not_tickers(spark):
    assert staging.stg_stock_prices(raw(spark, [("aapl", "2024-01-02", 1.0)])).first().ticker_symbol == "aapl"
    assert staging.stg_tickers(watchlist(spark, [(1, "aapl", True)])).first().ticker_symbol == "AAPL"

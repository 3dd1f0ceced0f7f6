import datetime as dt

from pyspark.sql import functions as F

from tickspan.plans.models import PriceModels
from tickspan.sources.holidays import market_holidays
from tests.helpers import raw, watchlist


def _models(spark, items, wl, calendar=("2024-01-01", "2024-12-31")):
    return PriceModels(raw(spark, items), watchlist(spark, wl), market_holidays(spark), calendar=calendar)


def test_calendar_join_keeps_weekends_drops_outside(spark):
    m = _models(spark, [("AAA", "2024-01-06", 1.0), ("AAA", "2025-01-02", 2.0)], [(1, "aaa", True)])
    got = [r.trading_date for r in m.fact_stock_price_daily.collect()]
    assert got == [dt.date(2024, 1, 6)]  # a Saturday is kept, 2025 is outside the calendar


def test_windows_run_before_calendar_join(spark):
    m = _models(spark, [("AAA", "2023-12-29", 100.0), ("AAA", "2024-01-02", 110.0)], [(1, "aaa", True)])
    r = m.fact_stock_performance_daily.collect()
    assert len(r) == 1 and float(r[0].previous_close_price) == 100.0
    assert abs(r[0].daily_return_pct - 0.1) < 1e-12 and r[0].moving_average_7d == 105.0


def test_ticker_join_rules(spark):
    items = [("AAA", "2024-01-02", 1.0), ("BBB", "2024-01-02", 1.0), ("ccc", "2024-01-02", 1.0),
             ("ZZZ", "2024-01-02", 1.0)]
    m = _models(spark, items, [(1, "aaa", True), (2, "bbb", False), (3, "ccc", True)])
    assert sorted(r.ticker_symbol for r in m.fact_stock_price_daily.collect()) == ["AAA", "BBB"]
    assert sorted(r.ticker_symbol for r in m.fact_stock_performance_daily.collect()) == ["AAA", "BBB"]
    assert [r.ticker_symbol for r in m.mart_watchlist_performance.collect()] == ["AAA"]


def test_dim_ticker_constants(spark):
    m = _models(spark, [], [(7, "aapl", True)])
    r = m.dim_ticker.first()
    assert (r.ticker_key, r.ticker_symbol, r.currency, r.country, r.asset_type) == (7, "AAPL", "USD", "US", None)
    assert dict(m.dim_ticker.dtypes)["sector"] == "string"


def test_year_split_gives_the_same_facts(spark):
    from tickspan.plans.models import PriceModels
    from tests.helpers import raw, watchlist
    items = [("AAA", "2024-12-30", 1.0), ("AAA", "2025-01-02", 2.0), ("AAA", "2025-01-03", 3.0)]
    one, split = (PriceModels(raw(spark, items), watchlist(spark, [(1, "aaa", True)]), split_by_year=s) for s in (False, True))
    assert sorted(one.fact_stock_performance_daily.collect()) == sorted(split.fact_stock_performance_daily.collect())


def test_calendar_join_drops_rows_outside_it_but_not_their_history(spark):
    """Rows before the calendar go, yet feed the first returns in it."""
    from tickspan.plans.models import PriceModels
    from tests.helpers import raw, watchlist
    m = PriceModels(raw(spark, [("AAA", "2023-12-29", 1.0), ("AAA", "2024-01-02", 2.0)]), watchlist(spark, [(1, "aaa", True)]),
                    calendar=("2024-01-01", "2024-12-31"))
    assert [(str(r.trading_date), r.daily_return_pct) for r in m.fact_stock_performance_daily.collect()] == [("2024-01-02", 1.0)]


def test_size_check_sees_a_side_that_grew(spark, scratch):
    from tickspan.operators.joins import join_small
    path = f"{scratch}/side"
    big = spark.range(5).withColumnRenamed("id", "k")

    def hinted():
        small = spark.read.parquet(path)
        return "broadcast" in join_small(big, small, "k", max_rows=100)._jdf.queryExecution().optimizedPlan().toString().lower()
    spark.range(10).withColumnRenamed("id", "k").write.parquet(path)
    assert hinted()
    spark.range(1000).withColumnRenamed("id", "k").write.mode("append").parquet(path)
    assert not hinted()
    spark.range(10).withColumnRenamed("id", "k").write.mode("overwrite").parquet(path)
    assert hinted()


def test_a_checked_side_is_not_gathered_into_one_task(spark):
    from tickspan.operators.joins import fits
    side = spark.range(0, 1000, 1, 8)
    assert fits(side, 1000) and not fits(side, 999)
    assert "Limit" not in side.groupBy().count()._jdf.queryExecution().executedPlan().toString()


def test_broadcast_cap_is_byte_based(spark):
    from tickspan.operators.joins import broadcast_row_cap, join_small
    narrow = spark.range(10).select(F.col("id"))
    wide = spark.range(10).select(*[F.lit("x").alias(f"s{i}") for i in range(20)])
    assert broadcast_row_cap(narrow) > broadcast_row_cap(wide) > 0
    big = spark.range(100).withColumnRenamed("id", "k")
    small = spark.range(10).withColumnRenamed("id", "k")
    assert "BroadcastExchange" in join_small(big, small, "k")._jdf.queryExecution().executedPlan().toString()
    # 1 KiB allows only a few rows of (k: bigint): 10 rows do not fit, no explicit broadcast
    hinted = join_small(big, small, "k", max_bytes=64)._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" not in hinted.lower()

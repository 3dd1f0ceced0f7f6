import datetime as dt

from pyspark.sql import functions as F

from tickspan.operators.calendar import dim_date
from tickspan.schemas import MARKET_HOLIDAYS
from tickspan.sources.holidays import market_holidays
from tickspan.sources.spine import date_spine


def _calendar(spark):
    return dim_date(date_spine(spark, "2024-01-01", "2027-12-31"), market_holidays(spark))


def test_golden_year_counts(spark):
    d = _calendar(spark)
    assert d.count() == 1461
    got = {r.calendar_year: (r.days, r.trading, r.hol, r.wknd) for r in d.groupBy("calendar_year").agg(
        F.count(F.lit(1)).alias("days"), F.count_if("is_trading_day").alias("trading"),
        F.count_if("is_market_holiday").alias("hol"), F.count_if("is_weekend").alias("wknd")).collect()}
    assert got == {2024: (366, 252, 10, 104), 2025: (365, 250, 11, 104),
                   2026: (365, 251, 10, 104), 2027: (365, 251, 10, 104)}


def test_adjacent_and_counters(spark):
    d = _calendar(spark)
    assert sorted(r.date_day for r in d.where(F.col("previous_trading_date").isNull()).collect()) == \
        [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]
    assert [r.date_day for r in d.where(F.col("next_trading_date").isNull()).collect()] == [dt.date(2027, 12, 31)]
    first = d.where("date_day = date'2024-01-01'").first()
    assert first.is_market_holiday and first.trading_day_of_month == 0 and first.trading_day_of_year == 0
    assert first.next_trading_date == dt.date(2024, 1, 2)
    last = d.where("date_day = date'2027-12-31'").first()
    assert last.calendar_week == 52 and last.week_start_date == dt.date(2027, 12, 27)
    assert last.week_end_date == dt.date(2028, 1, 2)
    assert (last.trading_day_of_month, last.trading_day_of_year) == (22, 251)
    assert last.date_key == 20271231 and last.day_of_week_short_name == "Fri"


def test_only_full_day_closures_of_the_market(spark):
    hol = spark.createDataFrame([
        (dt.date(2024, 1, 3), "NYSE", "early", False, True),
        (dt.date(2024, 1, 4), "LSE", "other market", True, False),
        (dt.date(2024, 1, 5), "NYSE", "closed", True, False)], MARKET_HOLIDAYS)
    d = dim_date(date_spine(spark, "2024-01-01", "2024-01-07"), hol)
    got = {r.date_day.day: r.is_trading_day for r in d.collect()}
    assert got == {1: True, 2: True, 3: True, 4: True, 5: False, 6: False, 7: False}

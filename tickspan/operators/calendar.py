"""Trading calendar dimension (one row per calendar day)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tickspan import functions as tf
from tickspan.operators.joins import join_small
from tickspan.schemas import DIM_DATE_COLUMNS

# A calendar is bounded by its date range (≤ 366 rows a year), so the global
# previous/next trading-day scan below can run in one task.


def closures(holidays: DataFrame, market_code: str = "NYSE") -> DataFrame:
    """Full-day closures of one market (early closes are trading days)."""
    return (holidays.where((F.col("market_code") == F.lit(market_code))
                           & (F.col("is_full_day_closure") == F.lit(True)))
            .select("holiday_date", "holiday_name"))


def dim_date(spine: DataFrame, holidays: DataFrame, market_code: str = "NYSE",
             holiday_rows: int | None = None) -> DataFrame:
    """Calendar attributes, holiday flags, adjacent trading days and running
    trading-day counters for every ``date_day`` of ``spine``.

    A date with two closures appears twice (left join), as in a plain SQL
    left join; keep the seed unique per date. ``holiday_rows``: a known row
    bound of the seed (else it is counted, with a cap, before broadcasting).
    """
    hol = closures(holidays, market_code)
    d = join_small(spine, hol, spine["date_day"] == hol["holiday_date"], "left",
                   known_rows=holiday_rows)
    day = F.col("date_day")
    dow = tf.iso_day_of_week(day)
    weekend = dow.isin(6, 7)
    d = d.select(
        day,
        tf.date_key(day).alias("date_key"),
        F.year(day).alias("calendar_year"),
        F.quarter(day).alias("calendar_quarter"),
        F.month(day).alias("calendar_month"),
        tf.month_name(day).alias("calendar_month_name"),
        tf.month_short_name(day).alias("calendar_month_short_name"),
        F.weekofyear(day).alias("calendar_week"),
        F.dayofmonth(day).alias("day_of_month"),
        dow.alias("day_of_week"),
        tf.day_name(day).alias("day_of_week_name"),
        tf.day_short_name(day).alias("day_of_week_short_name"),
        F.dayofyear(day).alias("day_of_year"),
        tf.week_start(day).alias("week_start_date"),
        tf.week_end(day).alias("week_end_date"),
        tf.month_start(day).alias("month_start_date"),
        tf.month_end(day).alias("month_end_date"),
        tf.quarter_start(day).alias("quarter_start_date"),
        tf.quarter_end(day).alias("quarter_end_date"),
        tf.year_start(day).alias("year_start_date"),
        tf.year_end(day).alias("year_end_date"),
        weekend.alias("is_weekend"),
        (~weekend).alias("is_weekday"),
        F.col("holiday_date").isNotNull().alias("is_market_holiday"),
        F.col("holiday_name").alias("market_holiday_name"),
        ((~weekend) & F.col("holiday_date").isNull()).alias("is_trading_day"),
    )
    trading_day = F.when(F.col("is_trading_day"), day)
    everything = Window.orderBy("date_day")
    d = d.select(
        "*",
        F.last(trading_day, ignorenulls=True)
         .over(everything.rowsBetween(Window.unboundedPreceding, -1)).alias("previous_trading_date"),
        F.first(trading_day, ignorenulls=True)
         .over(everything.rowsBetween(1, Window.unboundedFollowing)).alias("next_trading_date"),
    )
    one = F.col("is_trading_day").cast("int")
    running = Window.rowsBetween(Window.unboundedPreceding, 0)
    d = d.select(
        "*",
        F.sum(one).over(running.partitionBy("calendar_year", "calendar_month").orderBy("date_day"))
         .cast("int").alias("trading_day_of_month"),
        F.sum(one).over(running.partitionBy("calendar_year").orderBy("date_day"))
         .cast("int").alias("trading_day_of_year"),
    )
    return d.select(*DIM_DATE_COLUMNS)

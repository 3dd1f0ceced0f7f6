"""Date spine (S7): one row per calendar day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickspan.functions import year_end, year_start


def _as_date(d) -> dt.date:
    return d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d))


def date_spine(spark: SparkSession, start="2024-01-01", end="2027-12-31") -> DataFrame:
    """Every date from ``start`` to ``end`` inclusive, column ``date_day``.
    Generated with ``spark.range`` so it splits across tasks like any scan."""
    s, e = _as_date(start), _as_date(end)
    n_days = (e - s).days + 1
    if n_days <= 0:
        raise ValueError(f"empty calendar: {s}..{e}")
    return (spark.range(n_days)
            .select(F.date_add(F.lit(s), F.col("id").cast("int")).alias("date_day")))


def spine_size(start, end) -> int:
    """Number of rows ``date_spine`` returns: known before any job runs."""
    return (_as_date(end) - _as_date(start)).days + 1


def covering_years(df: DataFrame, date_col: str = "trading_date") -> DataFrame:
    """Spine covering whole calendar years around the dates in ``df``: from
    1 January of its first year to 31 December of its last. One partial
    aggregate over the data, then a bounded generator (≤ 366 rows per year)."""
    bounds = df.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi"))
    return bounds.select(
        F.explode(F.sequence(year_start("lo"), year_end("hi"))).alias("date_day"))

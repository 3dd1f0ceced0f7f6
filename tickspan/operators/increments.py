"""Latest-wins prices and indicators kept up to date from what was landed.

``merged_latest`` reads a compacted base (one row per key already) together with
raw rows landed since: only keys that were landed again are deduplicated, the
rest of the base passes through. ``refreshed_indicators`` recomputes indicators
from the first changed date of each ticker on, from the rows before it that the
frames reach (its halo); ``appended_indicators`` needs no more than the stored
tails of the tickers, where all new dates are later than theirs. All three give
what a full rebuild gives.

Defined results: rows without a ticker or a date are kept as the full rebuild
keeps them; empty changes leave the stored rows as they are; a changed row that
loses against the stored one (an older load) changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tickspan.operators.dedup import latest_per_key
from tickspan.operators.indicators import HALO_ROWS, INDICATOR_COLUMNS, daily_indicators
from tickspan.operators.joins import broadcast_row_cap, fits
from tickspan.session import cut_lineage, stored as write_stored

KEY = ["ticker_symbol", "trading_date"]


def _on_keys(df: DataFrame, keys: DataFrame, how: str, cols: list[str]) -> DataFrame:
    """Semi or anti join on keys that may be NULL."""
    other = keys.select(*[F.col(c).alias(f"_k_{c}") for c in cols])
    small = fits(other, broadcast_row_cap(other))
    cond = None
    for c in cols:
        part = F.col(c).eqNullSafe(F.col(f"_k_{c}"))
        cond = part if cond is None else cond & part
    return df.join(F.broadcast(other) if small else other, cond, how)


def merged_latest(base: DataFrame, landed: DataFrame, order_by: list) -> DataFrame:
    """One row per (ticker, date): the latest of ``base`` (one row per key) and
    ``landed`` (any number). Only base rows whose key was landed again meet the
    landed ones; the other rows are not shuffled where the keys are few."""
    keys = cut_lineage(landed.select(*KEY).distinct())
    untouched = _on_keys(base, keys, "left_anti", KEY)
    again = _on_keys(base, keys, "left_semi", KEY)
    return untouched.unionByName(latest_per_key(again.unionByName(landed), KEY, order_by).select(*base.columns))


def tails(indicators: DataFrame, rows: int = HALO_ROWS + 1) -> DataFrame:
    """The last rows of every ticker: what indicators of later dates are made from."""
    w = Window.partitionBy("ticker_symbol").orderBy(F.col("trading_date").desc())
    return indicators.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= rows).drop("_r")


def appended_indicators(tail: DataFrame, new: DataFrame) -> DataFrame:
    """Indicator rows of ``new`` (staged, one row per key, every date later than
    the ticker's in ``tail``), from the tails and the new rows alone."""
    prices = [c for c in new.columns]
    both = (tail.select(*prices).withColumn("_new", F.lit(False))
            .unionByName(new.withColumn("_new", F.lit(True))))
    return daily_indicators(both).where("_new").select(*prices, *INDICATOR_COLUMNS)


def refreshed_indicators(stored: DataFrame, landed: DataFrame, order_by: list) -> DataFrame:
    """Stored indicator rows brought up to date with staged rows landed since
    (not deduplicated): rows before a ticker's first changed date stay as they
    are, the rest is made anew from there and the halo before it."""
    prices = [c for c in stored.columns if c not in INDICATOR_COLUMNS]
    landed = write_stored(latest_per_key(landed.select(*prices), KEY, order_by), "landed")
    first = cut_lineage(landed.groupBy("ticker_symbol").agg(F.min("trading_date").alias("_from")))
    bounds = first.withColumnRenamed("ticker_symbol", "_t")
    # Three parts are read from this join: no stored row is shuffled for it where the tickers are few.
    bounds = F.broadcast(bounds) if fits(bounds, broadcast_row_cap(bounds)) else bounds
    joined = stored.join(bounds, F.col("ticker_symbol").eqNullSafe(F.col("_t")), "left").drop("_t")
    later = F.coalesce(F.col("trading_date") >= F.col("_from"), F.lit(False))
    keep = joined.where(F.col("_from").isNull() | ~later).drop("_from")
    touched = joined.where(F.col("_from").isNotNull())
    w = Window.partitionBy("ticker_symbol").orderBy(F.col("trading_date").desc())
    halo = (touched.where(~later).select(*prices, F.row_number().over(w).alias("_r")).where(F.col("_r") <= HALO_ROWS + 1).drop("_r"))
    redo = latest_per_key(touched.where(later).select(*prices).unionByName(landed), KEY, order_by).select(*prices)
    made = daily_indicators(halo.withColumn("_new", F.lit(False)).unionByName(redo.withColumn("_new", F.lit(True))))
    return keep.unionByName(made.where("_new").select(*prices, *INDICATOR_COLUMNS))

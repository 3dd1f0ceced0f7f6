"""Staging models: typed, renamed, deduplicated inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tickspan.operators.dedup import latest_per_key
from tickspan.operators.joins import join_small
from tickspan.schemas import PRICE, STG_STOCK_PRICES_COLUMNS

# Fixed tie-break after the latest load time: identical load times are settled
# by the row's own values, so the same row wins on every run.
TIE_BREAK = ["close_price", "open_price", "high_price", "low_price", "volume", "data_source"]


def renamed_prices(raw: DataFrame) -> DataFrame:
    """Raw price rows → staged names and types (prices decimal(18,4), rounded
    half-up; ANSI casts fail loudly on malformed input)."""
    return raw.select(
        F.col("symbol").alias("ticker_symbol"),
        F.col("trade_date").cast("date").alias("trading_date"),
        F.col("open").cast(PRICE).alias("open_price"),
        F.col("high").cast(PRICE).alias("high_price"),
        F.col("low").cast(PRICE).alias("low_price"),
        F.col("close").cast(PRICE).alias("close_price"),
        F.col("volume").cast("bigint").alias("volume"),
        F.col("source").alias("data_source"),
        F.col("loaded_at"),
    )


def dedup_order():
    return [F.col("loaded_at").desc_nulls_last()] + [F.col(c).desc_nulls_last() for c in TIE_BREAK]


def stg_stock_prices(raw: DataFrame, only: DataFrame | None = None, only_rows: int | None = None) -> DataFrame:
    """One row per (ticker, date): the latest load wins. The symbol is not
    upper-cased here. With ``only`` (ticker_symbol), rows of other tickers are
    left out before anything is shuffled."""
    rows = renamed_prices(raw)
    if only is not None:
        rows = join_small(rows, only.select("ticker_symbol"), "ticker_symbol", "left_semi", known_rows=only_rows)
    return stage_renamed(rows)


def stage_renamed(rows: DataFrame) -> DataFrame:
    """Renamed price rows → one row per (ticker, date)."""
    return latest_per_key(rows, ["ticker_symbol", "trading_date"], dedup_order()).select(*STG_STOCK_PRICES_COLUMNS)


def stg_tickers(watchlist: DataFrame) -> DataFrame:
    """Watchlist → staged tickers; symbols upper-cased, inactive rows kept."""
    return watchlist.select(
        F.col("watchlist_id").alias("ticker_id"),
        F.upper("symbol").alias("ticker_symbol"),
        "company_name", "category", "notes", "is_active", "created_at", "updated_at",
    )

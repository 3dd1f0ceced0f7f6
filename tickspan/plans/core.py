"""Core star schema: ticker and date dimensions, price and performance facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tickspan.operators.joins import join_small


def dim_ticker(stg_tickers: DataFrame) -> DataFrame:
    """Ticker dimension; attributes not yet in the watchlist are typed NULLs."""
    null = F.lit(None).cast("string")
    return stg_tickers.select(
        F.col("ticker_id").alias("ticker_key"), "ticker_symbol", "company_name",
        null.alias("asset_type"), null.alias("exchange_code"), null.alias("sector"),
        null.alias("industry"), F.lit("USD").alias("currency"), F.lit("US").alias("country"),
        "category", "notes", "is_active",
        F.col("created_at").alias("first_added_at"), F.col("updated_at").alias("last_updated_at"),
    )


def conform(facts: DataFrame, dim_date: DataFrame, dim_ticker: DataFrame,
            date_cols: list[str] | None = None, ticker_cols: list[str] | None = None,
            calendar_rows: int | None = None, ticker_rows: int | None = None) -> DataFrame:
    """Inner-join a (ticker_symbol, trading_date) fact with both dimensions.

    Drops dates outside the calendar (weekends and holidays inside it stay) and
    tickers absent from the watchlist (inactive ones stay). Both dimensions are
    broadcast behind a size check (``calendar_rows`` / ``ticker_rows``: row
    bounds already proven for the dimensions), so the fact is never shuffled
    for them.
    """
    dd = dim_date.select(F.col("date_day").alias("trading_date"), "date_key", *(date_cols or []))
    dt = dim_ticker.select("ticker_symbol", "ticker_key", *(ticker_cols or []))
    j = join_small(facts, dd, "trading_date", "inner", known_rows=calendar_rows)
    return join_small(j, dt, "ticker_symbol", "inner", known_rows=ticker_rows)


PRICE_FACT_COLUMNS = ["ticker_symbol", "ticker_key", "date_key", "trading_date", "open_price",
                      "high_price", "low_price", "close_price", "volume", "data_source", "loaded_at"]
PERFORMANCE_FACT_COLUMNS = ["ticker_symbol", "ticker_key", "date_key", "trading_date", "close_price",
                            "previous_close_price", "price_change", "daily_return_pct",
                            "moving_average_7d", "moving_average_20d", "moving_average_50d",
                            "volatility_20d", "annualized_volatility_20d"]


def fact_stock_price_daily(stg_prices: DataFrame, dim_date: DataFrame, dim_ticker: DataFrame,
                           calendar_rows: int | None = None, ticker_rows: int | None = None) -> DataFrame:
    return conform(stg_prices, dim_date, dim_ticker, calendar_rows=calendar_rows,
                   ticker_rows=ticker_rows).select(*PRICE_FACT_COLUMNS)


def fact_stock_performance_daily(indicators: DataFrame, dim_date: DataFrame, dim_ticker: DataFrame,
                                 calendar_rows: int | None = None, ticker_rows: int | None = None) -> DataFrame:
    """Indicators are computed over the full history *before* the calendar
    join, so the first in-calendar rows still see earlier prices."""
    return conform(indicators, dim_date, dim_ticker, calendar_rows=calendar_rows,
                   ticker_rows=ticker_rows).select(*PERFORMANCE_FACT_COLUMNS)

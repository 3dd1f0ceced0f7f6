"""Finance marts: active-ticker daily performance and the period summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tickspan.operators.periods import period_summary
from tickspan.plans.core import conform

MART_DATE_COLUMNS = ["calendar_year", "calendar_quarter", "calendar_month", "calendar_month_name"]
MART_COLUMNS = [
    "ticker_symbol", "company_name", "category", "currency", "country", "is_active",
    "trading_date", "calendar_year", "calendar_quarter", "calendar_month", "calendar_month_name",
    "close_price", "previous_close_price", "daily_return_pct",
    "moving_average_7d", "moving_average_20d", "moving_average_50d",
    "volatility_20d", "annualized_volatility_20d", "volume",
]


def mart_watchlist_performance(indicators: DataFrame, dim_date: DataFrame, dim_ticker: DataFrame,
                               calendar_rows: int | None = None, ticker_rows: int | None = None) -> DataFrame:
    """Daily performance of *active* tickers with calendar attributes.

    Volume rides along from the one-pass indicators (same rows as the price
    fact), and the active filter is applied to the dimension before the
    broadcast, so inactive tickers never reach the fact side."""
    active = dim_ticker.where(F.col("is_active") == F.lit(True))
    j = conform(indicators, dim_date, active, date_cols=MART_DATE_COLUMNS,
                ticker_cols=["company_name", "category", "currency", "country", "is_active"],
                calendar_rows=calendar_rows, ticker_rows=ticker_rows)
    return j.select(*MART_COLUMNS)


def mart_ticker_performance_summary(performance_with_volume: DataFrame, dim_ticker: DataFrame,
                                    anchor_dates: DataFrame | None = None,
                                    ticker_rows: int | None = None) -> DataFrame:
    """Per (ticker, period) summary over the conformed performance fact
    (inactive tickers included; anchors global over all tickers)."""
    return period_summary(performance_with_volume, dim_ticker, anchor_dates, ticker_rows)

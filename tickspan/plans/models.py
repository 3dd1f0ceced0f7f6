"""The model graph: raw inputs → staging → intermediate → marts.

``PriceModels`` builds each dataset lazily from the ones below it, each model
referring to the ones it reads. Views stay lazy ``DataFrame``s; marts are
what ``tickspan.sources.sinks.materialize`` writes as tables.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, functions as F

from tickspan.operators.calendar import dim_date as build_dim_date
from tickspan.operators.indicators import daily_indicators
from tickspan.operators.joins import join_small
from tickspan.plans import core, marts, staging
from tickspan.sources.holidays import market_holidays, seed_size
from tickspan.sources.spine import date_spine, spine_size

# (layer, materialization) of each model.
MODEL_LAYERS = {
    "stg_market__stock_prices": ("STAGING", "view"),
    "stg_market__tickers": ("STAGING", "view"),
    "int_stock_daily_returns": ("INTERMEDIATE", "view"),
    "int_stock_moving_averages": ("INTERMEDIATE", "view"),
    "int_stock_volatility": ("INTERMEDIATE", "view"),
    "dim_ticker": ("MARTS", "table"),
    "dim_date": ("MARTS", "table"),
    "fact_stock_price_daily": ("MARTS", "table"),
    "fact_stock_performance_daily": ("MARTS", "table"),
    "mart_watchlist_performance": ("MARTS", "table"),
    "mart_ticker_performance_summary": ("MARTS", "table"),
}


class PriceModels:
    """All datasets for one set of inputs.

    raw_prices  – rows in the ``RAW_STOCK_PRICES`` layout (duplicates allowed)
    watchlist   – rows in the ``WATCHLIST`` layout
    holidays    – seed rows (default: the built-in NYSE seed)
    calendar    – (start, end) of the date dimension; ``None`` covers the whole
                  years spanned by the staged prices
    split_by_year – run the indicator windows per (ticker, year) with halos
                  instead of per ticker (see ``operators.indicators``); results
                  are equal. After dedup a ticker holds one row per day at
                  most (36,600 a century), so daily bars do not need it;
                  it is for bars finer than a day
    """

    def __init__(self, raw_prices: DataFrame, watchlist: DataFrame, holidays: DataFrame | None = None,
                 calendar: tuple | None = ("2024-01-01", "2027-12-31"), market_code: str = "NYSE",
                 split_by_year: bool = False):
        self.spark = raw_prices.sparkSession
        self.raw_prices = raw_prices
        self.watchlist = watchlist
        self.holidays = holidays if holidays is not None else market_holidays(self.spark)
        self.holiday_rows = None if holidays is not None else seed_size()
        self.calendar = calendar
        self.market_code = market_code
        self.split_by_year = split_by_year

    # -- staging -----------------------------------------------------------
    @cached_property
    def stg_market__stock_prices(self) -> DataFrame:
        return staging.stg_stock_prices(self.raw_prices)

    @cached_property
    def stg_market__tickers(self) -> DataFrame:
        return staging.stg_tickers(self.watchlist)

    # -- intermediate (one pass, three projections) --------------------------
    @cached_property
    def indicators(self) -> DataFrame:
        return daily_indicators(self.stg_market__stock_prices, split_by_year=self.split_by_year)

    @property
    def active_indicators(self) -> DataFrame:
        """Indicators of active tickers. Dedup and windows never leave a ticker,
        so the raw rows of the others are dropped first (unless the indicators
        of all tickers are there already)."""
        if "_shared" in self.__dict__:
            return self.indicators
        active = self.dim_ticker.where(F.col("is_active") == F.lit(True))
        return daily_indicators(staging.stg_stock_prices(self.raw_prices, active, self.ticker_rows), split_by_year=self.split_by_year)

    @cached_property
    def int_stock_daily_returns(self) -> DataFrame:
        return self.indicators.select(
            "ticker_symbol", "trading_date", "open_price", "high_price", "low_price", "close_price",
            "volume", "previous_close_price", "price_change", "daily_return_pct")

    @cached_property
    def int_stock_moving_averages(self) -> DataFrame:
        return self.indicators.select("ticker_symbol", "trading_date", "close_price",
                                      "moving_average_7d", "moving_average_20d", "moving_average_50d")

    @cached_property
    def int_stock_volatility(self) -> DataFrame:
        return self.indicators.select("ticker_symbol", "trading_date", "daily_return_pct",
                                      "volatility_20d", "annualized_volatility_20d")

    # -- core --------------------------------------------------------------
    @cached_property
    def calendar_rows(self) -> int:
        """Rows of the date dimension, known before it is built."""
        return spine_size(*self.calendar_bounds) if self.calendar_bounds else 0

    @cached_property
    def ticker_rows(self) -> int:
        """Rows of the ticker dimension (one count, reused by every join with it)."""
        return self.dim_ticker.count()

    @cached_property
    def calendar_bounds(self) -> tuple | None:
        """First and last day of the calendar: the parameter, or the whole years
        of the trade dates (one partial min/max; dedup never changes the dates)."""
        if self.calendar:
            return self.calendar
        lo, hi = self._keys.agg(F.min("trading_date"), F.max("trading_date")).first()
        return None if lo is None else (lo.replace(month=1, day=1), hi.replace(month=12, day=31))

    @cached_property
    def date_spine(self) -> DataFrame:
        if self.calendar_bounds is None:
            return self.spark.createDataFrame([], "date_day date")
        return date_spine(self.spark, *self.calendar_bounds)

    @property
    def _keys(self) -> DataFrame:
        """(ticker_symbol, trading_date) of every price row: from the raw scan, or
        from the shared table once there is one (the same pairs, deduplicated)."""
        src = self.__dict__.get("_shared")
        if src is None:
            src = staging.renamed_prices(self.raw_prices)
        return src.select("ticker_symbol", "trading_date")

    @cached_property
    def dim_date(self) -> DataFrame:
        return build_dim_date(self.date_spine, self.holidays, self.market_code, self.holiday_rows)

    @cached_property
    def dim_ticker(self) -> DataFrame:
        return core.dim_ticker(self.stg_market__tickers)

    @cached_property
    def fact_stock_price_daily(self) -> DataFrame:
        return core.fact_stock_price_daily(self.stg_market__stock_prices, self.dim_date,
                                           self.dim_ticker, self.calendar_rows, self.ticker_rows)

    @cached_property
    def performance_with_volume(self) -> DataFrame:
        """Performance fact plus volume (the price fact's rows are the same
        (ticker, date) set, so no join back to it is needed)."""
        return core.conform(self.indicators, self.dim_date, self.dim_ticker,
                            calendar_rows=self.calendar_rows, ticker_rows=self.ticker_rows).select(
            *core.PERFORMANCE_FACT_COLUMNS, "volume")

    @cached_property
    def conformed_dates(self) -> DataFrame:
        """Trading dates of raw rows that survive both dimension joins: the
        same date set as either fact, without dedup or windows. Used for the
        global period anchors (a scan, two broadcast semi-joins, a partial
        max/min)."""
        r = self._keys
        dd = self.dim_date.select(F.col("date_day").alias("trading_date"))
        dt = self.dim_ticker.select("ticker_symbol")
        r = join_small(r, dd, "trading_date", "left_semi", known_rows=self.calendar_rows)
        return join_small(r, dt, "ticker_symbol", "left_semi", known_rows=self.ticker_rows).select("trading_date")

    @cached_property
    def active_keys(self) -> DataFrame:
        """(ticker_symbol, trading_date) of the active-ticker mart, from the raw
        scan: two broadcast semi-joins, no dedup or windows (the page's period
        anchor is the active-only mart, not all tickers)."""
        r = self._keys
        dd = self.dim_date.select(F.col("date_day").alias("trading_date"))
        dt = self.dim_ticker.where(F.col("is_active") == F.lit(True)).select("ticker_symbol")
        r = join_small(r, dd, "trading_date", "left_semi", known_rows=self.calendar_rows)
        return join_small(r, dt, "ticker_symbol", "left_semi", known_rows=self.ticker_rows)

    @cached_property
    def active_dates(self) -> DataFrame:
        return self.active_keys.select("trading_date")

    def history(self, period: str = "ALL_AVAILABLE", symbol: str | None = None,
                ordered: bool = True) -> DataFrame:
        """Ticker history view over the active mart (numeric). Where it is ordered
        its rows are stored first: sorting reads its input twice (once for the
        range bounds), which would run dedup's second half and the windows twice."""
        from tickspan.operators.analytics import HISTORY_ORDER, ticker_history
        from tickspan.session import stored
        rows = ticker_history(self.mart_watchlist_performance, period, symbol,
                              anchor_dates=self.active_dates, ordered=False)
        return stored(rows, "history").orderBy(*HISTORY_ORDER) if ordered else rows

    def benchmark_comparison(self, period: str = "90D", benchmark: str | None = None) -> DataFrame:
        """Cumulative returns of every active ticker next to ``benchmark``'s
        (default: the first active symbol with history in the period)."""
        from tickspan.operators.analytics import benchmark_comparison
        return benchmark_comparison(self.history(period, ordered=False), benchmark, series_rows=self.calendar_rows)

    @cached_property
    def fact_stock_performance_daily(self) -> DataFrame:
        return self.performance_with_volume.select(*core.PERFORMANCE_FACT_COLUMNS)

    # -- marts -------------------------------------------------------------
    @cached_property
    def mart_watchlist_performance(self) -> DataFrame:
        return marts.mart_watchlist_performance(self.active_indicators, self.dim_date, self.dim_ticker,
                                                self.calendar_rows, self.ticker_rows)

    @cached_property
    def mart_ticker_performance_summary(self) -> DataFrame:
        return marts.mart_ticker_performance_summary(self.performance_with_volume, self.dim_ticker,
                                                     self.conformed_dates, self.ticker_rows)

    def share_intermediates(self) -> None:
        """Compute dedup and the indicator pass once and cut their lineage with
        one table written to the shared checkpoint folder. The indicator
        rows carry every staged column (one row per staged row), so the staged
        prices become a projection of the same table, of which a reader takes
        only its own columns. Every later model
        (facts, marts, checks) reads it instead of re-running dedup and
        windows. Call before building several models from one graph."""
        from tickspan.schemas import STG_STOCK_PRICES_COLUMNS
        from tickspan.session import stored
        if "_shared" in self.__dict__:
            return
        shared = stored(self.indicators, "indicators")
        for name in ("stg_market__stock_prices", "int_stock_daily_returns", "int_stock_moving_averages",
                     "int_stock_volatility", "fact_stock_price_daily", "performance_with_volume",
                     "fact_stock_performance_daily", "mart_watchlist_performance",
                     "mart_ticker_performance_summary", "conformed_dates", "active_keys", "active_dates"):
            self.__dict__.pop(name, None)
        self.__dict__["indicators"] = shared
        self.__dict__["stg_market__stock_prices"] = shared.select(*STG_STOCK_PRICES_COLUMNS)
        self.__dict__["_shared"] = shared

    def model(self, name: str) -> DataFrame:
        if name not in MODEL_LAYERS:
            raise KeyError(f"unknown model {name!r}")
        return getattr(self, name)

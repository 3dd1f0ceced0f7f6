"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator group, each over the whole provided tables (see ``sources.testfeeds``).

Computed columns carry the same names as in ``oracle_sql``. Where two engines
differ only in the last bits of a floating-point aggregate, the column is
rounded in the registered query (the library functions return it unrounded).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickspan.operators import analytics as an
from tickspan.operators import increments, periods
from tickspan.operators.indicators import daily_indicators
from tickspan.operators.periods import anchors
from tickspan.operators import quality as dq
from tickspan.operators import watchlist as wl
from tickspan.plans.core import conform
from tickspan.plans.models import PriceModels
from tickspan.schemas import RAW_STOCK_PRICES
from tickspan.sources import api_json, sinks, testfeeds, versions
from tickspan.session import ensure_checkpoint_dir
from tickspan.sources.holidays import market_holidays
from tickspan.sources.spine import covering_years
from tickspan.sources.starter import starter_tickers

# Both feeds use the whole years that their dates cover as their calendar.

VOL_DIGITS = 6
AVG_DIGITS = 6


def feed_a(spark: SparkSession, sf_dir: str, split_by_year: bool = False) -> PriceModels:
    return PriceModels(testfeeds.feed_a_raw_prices(spark, sf_dir), testfeeds.feed_a_watchlist(spark, sf_dir),
                       calendar=None, split_by_year=split_by_year)


def feed_b(spark: SparkSession, sf_dir: str, holidays: DataFrame | None = None) -> PriceModels:
    # No watchlist in feed B: every bar symbol is its own ticker.
    raw = testfeeds.feed_b_raw_prices(spark, sf_dir)
    return PriceModels(raw, _watchlist_from_symbols(raw), holidays, calendar=None)


def _watchlist_from_symbols(raw: DataFrame) -> DataFrame:
    ts = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    syms = raw.select("symbol").distinct()
    return syms.select(
        F.lit(None).cast("bigint").alias("watchlist_id"), F.col("symbol"),
        F.lit(None).cast("string").alias("company_name"), F.lit(None).cast("string").alias("category"),
        F.lit(None).cast("string").alias("notes"), F.lit(True).alias("is_active"),
        ts.alias("created_at"), ts.alias("updated_at"))


def _round(df: DataFrame, cols: list[str], digits: int) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in cols})


# -- staging / intermediate ---------------------------------------------------

def dedup_latest_prices(spark, sf_dir):
    return feed_a(spark, sf_dir).stg_market__stock_prices


def daily_returns(spark, sf_dir):
    return feed_a(spark, sf_dir).int_stock_daily_returns


def moving_averages(spark, sf_dir):
    return feed_a(spark, sf_dir).int_stock_moving_averages


def rolling_volatility(spark, sf_dir):
    return _round(feed_a(spark, sf_dir).int_stock_volatility,
                  ["volatility_20d", "annualized_volatility_20d"], VOL_DIGITS)


def stage_tickers(spark, sf_dir):
    return feed_a(spark, sf_dir).stg_market__tickers


def dim_ticker(spark, sf_dir):
    return feed_a(spark, sf_dir).dim_ticker


QUERIES = {
    "dedup_latest_prices": dedup_latest_prices,
    "daily_returns": daily_returns,
    "moving_averages": moving_averages,
    "rolling_volatility": rolling_volatility,
    "stage_tickers": stage_tickers,
    "dim_ticker": dim_ticker,
}


# -- calendar -------------------------------------------------------------------

def date_spine(spark, sf_dir):
    """Whole years covered by feed A's trade dates."""
    return covering_years(testfeeds.feed_a_raw_prices(spark, sf_dir), "trade_date")


def dim_date(spark, sf_dir):
    """Trading calendar over the years of feed B's bars, with the holiday seed."""
    return feed_b(spark, sf_dir).dim_date


def trading_day_counters(spark, sf_dir):
    return dim_date(spark, sf_dir).select("date_day", "is_trading_day", "trading_day_of_month",
                                          "trading_day_of_year")


def adjacent_trading_dates(spark, sf_dir):
    return dim_date(spark, sf_dir).select("date_day", "is_trading_day", "previous_trading_date",
                                          "next_trading_date")


def dim_date_from_csv(spark, sf_dir):
    """The same calendar with the holiday seed read from a CSV file."""
    path = _written(market_holidays(spark), "holidays", "csv", header=True)
    return feed_b(spark, sf_dir, market_holidays(spark, path)).dim_date


def trading_calendar_bars(spark, sf_dir):
    """Daily bars of feed B conformed to the trading calendar (weekend and
    holiday bars are kept and flagged)."""
    m = feed_b(spark, sf_dir)
    return conform(m.stg_market__stock_prices, m.dim_date, m.dim_ticker,
                   date_cols=["is_trading_day", "is_market_holiday", "market_holiday_name",
                              "day_of_week_short_name"]).select(
        "ticker_symbol", "trading_date", "date_key", "open_price", "high_price", "low_price",
        "close_price", "volume", "is_trading_day", "is_market_holiday", "market_holiday_name",
        "day_of_week_short_name")


# -- core facts and marts ------------------------------------------------------

def fact_price_daily(spark, sf_dir):
    return feed_a(spark, sf_dir).fact_stock_price_daily


def fact_performance_daily(spark, sf_dir):
    return _round(feed_a(spark, sf_dir).fact_stock_performance_daily,
                  ["volatility_20d", "annualized_volatility_20d"], VOL_DIGITS)


def mart_active_performance(spark, sf_dir):
    return _round(feed_a(spark, sf_dir).mart_watchlist_performance,
                  ["volatility_20d", "annualized_volatility_20d"], VOL_DIGITS)


def period_anchors(spark, sf_dir):
    """From the dates that pass both dimension joins: no dedup, no window."""
    return anchors(feed_a(spark, sf_dir).conformed_dates)


def period_definitions(spark, sf_dir):
    return periods.period_definitions(feed_a(spark, sf_dir).conformed_dates)


def period_summary(spark, sf_dir):
    return _round(feed_a(spark, sf_dir).mart_ticker_performance_summary,
                  ["avg_daily_return_pct", "volatility_pct", "avg_volume"], AVG_DIGITS)


QUERIES.update({
    "date_spine": date_spine,
    "dim_date": dim_date,
    "dim_date_from_csv": dim_date_from_csv,
    "trading_day_counters": trading_day_counters,
    "adjacent_trading_dates": adjacent_trading_dates,
    "trading_calendar_bars": trading_calendar_bars,
    "fact_price_daily": fact_price_daily,
    "fact_performance_daily": fact_performance_daily,
    "mart_active_performance": mart_active_performance,
    "period_anchors": period_anchors,
    "period_definitions": period_definitions,
    "period_summary": period_summary,
})


# -- page analytics (all tickers at once) ------------------------------------------

ANALYTICS_PERIOD = "90D"
# (query, period, symbol): the other periods of the history view (an unknown one
# has no bound), and a point lookup.
POINT_SYMBOL = "S1"
HISTORIES = [("ticker_history_30d", "30D", None), ("ticker_history_ytd", "YTD", None), ("ticker_history_1y", "1Y", None),
             ("ticker_history_all", "ALL_AVAILABLE", None), ("ticker_history_unknown", "5Y", None),
             ("ticker_history_symbol", "1Y", POINT_SYMBOL)]
_VOL = ["volatility_20d", "annualized_volatility_20d"]


def _history(spark, sf_dir):
    return feed_a(spark, sf_dir).history(ANALYTICS_PERIOD, ordered=False)


def ticker_history_90d(spark, sf_dir):
    return _round(feed_a(spark, sf_dir).history(ANALYTICS_PERIOD), _VOL, VOL_DIGITS)


def summary_ordered(spark, sf_dir):
    return _round(an.ordered_summary(feed_a(spark, sf_dir).mart_ticker_performance_summary),
                  ["avg_daily_return_pct", "volatility_pct", "avg_volume"], AVG_DIGITS)


def latest_snapshot(spark, sf_dir):
    return _round(an.latest_snapshot(_history(spark, sf_dir)), ["annualized_volatility_20d"], VOL_DIGITS)


def signals(spark, sf_dir):
    return an.signals(an.latest_snapshot(_history(spark, sf_dir)))


def benchmark_cumulative_return(spark, sf_dir):
    return feed_a(spark, sf_dir).benchmark_comparison(ANALYTICS_PERIOD)


def investment_scenario(spark, sf_dir):
    return _round(an.investment_scenario(_history(spark, sf_dir)), ["avg_daily_volume"], AVG_DIGITS)


def chart_series(spark, sf_dir):
    return an.chart_series(_history(spark, sf_dir))


def summary_display(spark, sf_dir):
    return an.summary_display(feed_a(spark, sf_dir).mart_ticker_performance_summary)


def _history_of(period, symbol=None):
    def query(spark, sf_dir):
        return _round(feed_a(spark, sf_dir).history(period, symbol), _VOL, VOL_DIGITS)
    query.__doc__ = f"History of {symbol or 'every ticker'} from the start of {period}."
    return query


def summary_of_symbol(spark, sf_dir):
    return _round(an.ordered_summary(feed_a(spark, sf_dir).mart_ticker_performance_summary, symbol=POINT_SYMBOL),
                  ["avg_daily_return_pct", "volatility_pct", "avg_volume"], AVG_DIGITS)


def watchlist_listing_active(spark, sf_dir):
    return an.watchlist_listing(testfeeds.feed_a_watchlist(spark, sf_dir), include_inactive=False)


def watchlist_listing(spark, sf_dir):
    return an.watchlist_listing(testfeeds.feed_a_watchlist(spark, sf_dir))


def active_symbols(spark, sf_dir):
    return an.active_symbols(testfeeds.feed_a_watchlist(spark, sf_dir))


QUERIES.update({
    "ticker_history_90d": ticker_history_90d,
    "summary_ordered": summary_ordered,
    "latest_snapshot": latest_snapshot,
    "signals": signals,
    "benchmark_cumulative_return": benchmark_cumulative_return,
    "investment_scenario": investment_scenario,
    "chart_series": chart_series,
    "summary_display": summary_display,
    "watchlist_listing": watchlist_listing,
    "active_symbols": active_symbols,
    "summary_of_symbol": summary_of_symbol,
    "watchlist_listing_active": watchlist_listing_active,
    **{name: _history_of(period, symbol) for name, period, symbol in HISTORIES},
})


# -- watchlist changes (feed C) ----------------------------------------------------

FEED_C_LOAD_TS = "2024-02-01 00:00:00"


def watchlist_apply_changes(spark, sf_dir):
    return wl.apply_changes(testfeeds.feed_c_changes(spark, sf_dir))


def watchlist_change_outcomes(spark, sf_dir):
    return wl.change_outcomes(testfeeds.feed_c_changes(spark, sf_dir))


def watchlist_outcomes_dirty(spark, sf_dir):
    """Outcomes of a log with missing and blank symbols and missing times."""
    return wl.change_outcomes(testfeeds.feed_c_dirty(spark, sf_dir))


def watchlist_outcomes_hot_symbol(spark, sf_dir):
    """Outcomes of a log that one symbol and one day dominate."""
    return wl.change_outcomes(testfeeds.feed_c_hot(spark, sf_dir))


def watchlist_hot_symbol_applied(spark, sf_dir):
    """The snapshot after that log, cut into more blocks than there are cores."""
    return wl.apply_changes(testfeeds.feed_c_hot(spark, sf_dir), blocks=32)


def starter_rows_inserted(spark, sf_dir):
    """The starter tickers inserted into feed A's watchlist."""
    return wl.insert_if_absent(testfeeds.feed_a_watchlist(spark, sf_dir), starter_tickers(spark), load_ts=FEED_C_LOAD_TS)


def raw_rows_with_defaults(spark, sf_dir):
    """Feed A's rows landed without source and load time."""
    rows = testfeeds.feed_a_raw_prices(spark, sf_dir).withColumn(
        "loaded_at", F.when(F.col("volume") % 2 == 0, F.col("loaded_at"))).drop("source")
    return sinks.with_load_defaults(rows, loaded_at=FEED_C_LOAD_TS)


def watchlist_fold_from_snapshot(spark, sf_dir):
    """Two-step fold: the change log applied on top of the snapshot produced by
    the same log's ``add`` events alone (snapshot rows enter as seeds)."""
    ch = testfeeds.feed_c_changes(spark, sf_dir)
    first = wl.apply_changes(ch.where(F.col("op") == "add"))
    return wl.apply_changes(ch.where(F.col("op") != "add"), snapshot=first)


def insert_if_absent(spark, sf_dir):
    """Bar symbols of feed B and staged tickers of feed A inserted into the
    watchlist folded from feed C, where not already present (feed B's symbols
    all are; feed A's are not)."""
    current = wl.apply_changes(testfeeds.feed_c_changes(spark, sf_dir))
    bars = (testfeeds.feed_b_raw_prices(spark, sf_dir).select("symbol").distinct()
            .select("symbol", F.lit(None).cast("string").alias("company_name"),
                    F.lit("auto").alias("category"), F.lit(None).cast("string").alias("notes")))
    staged = feed_a(spark, sf_dir).stg_market__tickers.select(
        F.col("ticker_symbol").alias("symbol"), "company_name", "category", "notes")
    cands = bars.unionByName(staged)
    return wl.insert_if_absent(current, cands, load_ts=FEED_C_LOAD_TS)


QUERIES.update({
    "watchlist_apply_changes": watchlist_apply_changes,
    "watchlist_change_outcomes": watchlist_change_outcomes,
    "watchlist_outcomes_dirty": watchlist_outcomes_dirty,
    "watchlist_outcomes_hot_symbol": watchlist_outcomes_hot_symbol,
    "watchlist_hot_symbol_applied": watchlist_hot_symbol_applied,
    "starter_rows_inserted": starter_rows_inserted,
    "raw_rows_with_defaults": raw_rows_with_defaults,
    "watchlist_fold_from_snapshot": watchlist_fold_from_snapshot,
    "insert_if_absent": insert_if_absent,
})


# -- data quality over feed A's models --------------------------------------------


DQ_VIOLATING = ("stg_market__stock_prices", "stg_market__tickers", "dim_ticker", "dim_date", "fact_stock_price_daily")


def _checked_models(spark, sf_dir) -> PriceModels:
    """Feed A's models with dedup and the indicator pass computed once and
    checkpointed, so the checks over eleven models do not re-run them."""
    m = feed_a(spark, sf_dir)
    m.share_intermediates()
    return m


def dq_not_null(spark, sf_dir):
    return dq.not_null_suite(_checked_models(spark, sf_dir))


def dq_unique(spark, sf_dir):
    # Tickers and the calendar only: nothing to share.
    return dq.unique_suite(feed_a(spark, sf_dir))


def dq_accepted(spark, sf_dir):
    return dq.accepted_suite(_checked_models(spark, sf_dir))


def dq_relationships(spark, sf_dir):
    return dq.relationships_suite(_checked_models(spark, sf_dir))


def dq_grain(spark, sf_dir):
    return dq.grain_suite(_checked_models(spark, sf_dir))


class _Violating:
    """Models that break the declared tests: raw rows before dedup with holes
    and a foreign source, tickers listed twice, facts of tickers and days that
    the dimensions lack."""

    def __init__(self, spark, sf_dir):
        from tickspan.plans.staging import renamed_prices
        m = feed_a(spark, sf_dir)
        raw = renamed_prices(testfeeds.feed_a_raw_prices(spark, sf_dir))
        stg = raw.withColumns({"open_price": F.when(F.col("volume") % 7 != 0, F.col("open_price")),
                               "data_source": F.when(F.col("volume") % 5 == 0, F.lit("manual")).otherwise(F.col("data_source"))})
        tickers = m.stg_market__tickers
        twice = tickers.where(F.col("ticker_id") % 2 == 0).withColumn("ticker_id", F.lit(None).cast("bigint"))
        fact = stg.withColumns({"ticker_key": F.when(F.col("volume") % 3 != 0, F.col("volume")),
                                "date_key": F.date_format("trading_date", "yyyyMMdd").cast("int")})
        self.models = {"stg_market__stock_prices": stg, "stg_market__tickers": tickers.unionByName(twice),
                       "dim_ticker": m.dim_ticker.where("is_active"), "dim_date": m.dim_date.where("calendar_quarter <> 1"),
                       "fact_stock_price_daily": fact}

    def model(self, name):
        return self.models[name]


def dq_violations(spark, sf_dir):
    return dq.run_suite(_Violating(spark, sf_dir), DQ_VIOLATING)


QUERIES.update({
    "dq_not_null": dq_not_null,
    "dq_unique": dq_unique,
    "dq_accepted": dq_accepted,
    "dq_relationships": dq_relationships,
    "dq_grain": dq_grain,
    "dq_violations": dq_violations,
})


# -- landed API documents (round trip through JSON) -----------------------------------

REJECT_NOTE = "Thank you for using the API. Request limit reached."
REJECT_INFO = "This is a premium endpoint."


def _landed_documents(spark, sf_dir):
    """Documents built from feed A's raw rows (one per symbol, month and
    copy), plus one without a series for every inactive watchlist symbol: a
    rate-limit note, an information text, another key, or a broken body."""
    docs = api_json.series_documents(testfeeds.feed_a_raw_prices(spark, sf_dir))
    kind = F.pmod("watchlist_id", F.lit(4))
    body = (F.when(kind == 0, F.to_json(F.struct(F.lit(REJECT_NOTE).alias("Note"))))
            .when(kind == 1, F.to_json(F.struct(F.lit("").alias("Note"), F.lit(REJECT_INFO).alias("Information"))))
            .when(kind == 2, F.to_json(F.struct(F.concat(F.lit("no symbol "), F.col("symbol")).alias("Error Message"))))
            .otherwise(F.concat(F.lit('{"Note": "cut short '), F.col("symbol"))))
    inactive = (testfeeds.feed_a_watchlist(spark, sf_dir).where(~F.col("is_active"))
                .select(F.upper("symbol").alias("symbol"), F.col("updated_at").alias("fetched_at"), body.alias("body")))
    return docs.unionByName(inactive)


def json_series_flatten(spark, sf_dir):
    return api_json.flatten_series(api_json.parse_bodies(_landed_documents(spark, sf_dir))).drop("loaded_at")


def json_series_rejects(spark, sf_dir):
    return api_json.rejects(api_json.parse_bodies(_landed_documents(spark, sf_dir))).drop("fetched_at")


def _written(df: DataFrame, name: str, kind: str, **options) -> str:
    """Write a derived input file below the shared checkpoint folder."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.format(kind).options(**options).save(path)
    return path


def _landed_files(spark, sf_dir):
    """The same documents landed as JSON lines, bodies nested as the API sends
    them, and read back."""
    docs = _landed_documents(spark, sf_dir)
    head = F.to_json(F.struct("symbol", "fetched_at"))
    line = F.concat(F.substring(head, F.lit(1), F.length(head) - 1), F.lit(',"body":'), F.col("body"), F.lit("}"))
    return api_json.read_landed(spark, _written(docs.select(line.alias("value")), "landed", "text"))


def landed_files_flatten(spark, sf_dir):
    return api_json.flatten_series(_landed_files(spark, sf_dir)).drop("loaded_at")


def landed_files_rejects(spark, sf_dir):
    return api_json.rejects(_landed_files(spark, sf_dir)).select("symbol", "message")


QUERIES.update({
    "json_series_flatten": json_series_flatten,
    "json_series_rejects": json_series_rejects,
    "landed_files_flatten": landed_files_flatten,
    "landed_files_rejects": landed_files_rejects,
})


# -- skew-safe indicator path on the whole data ---------------------------------------

def indicators_year_buckets(spark, sf_dir):
    """All indicator columns computed per (ticker, year) with 49-row halos
    (the option for finer-than-daily bars), checked against the three
    separate window models joined back."""
    return _round(feed_a(spark, sf_dir, split_by_year=True).indicators, _VOL, VOL_DIGITS)


QUERIES["indicators_year_buckets"] = indicators_year_buckets


# -- sinks: what is written is read back ---------------------------------------------

def landed_append_repeated(spark, sf_dir):
    """Feed A's rows appended in two batches, of which the second is given twice."""
    rows = testfeeds.feed_a_raw_prices(spark, sf_dir)
    path = f"{ensure_checkpoint_dir(spark)}/raw-{uuid.uuid4().hex}"
    even = F.pmod(F.col("volume"), F.lit(2)) == 0
    for number, part in ((0, rows.where(even)), (1, rows.where(~even)), (1, rows.where(~even))):
        sinks.append_raw(part, path, batch=("feed-a", number))
    return spark.read.schema(RAW_STOCK_PRICES).parquet(path)


def _rebuilt(spark, sf_dir, names) -> str:
    """Layers built twice into versions, the first time from half of the rows."""
    root = f"{ensure_checkpoint_dir(spark)}/warehouse-{uuid.uuid4().hex}"
    raw, wl_rows = testfeeds.feed_a_raw_prices(spark, sf_dir), testfeeds.feed_a_watchlist(spark, sf_dir)
    for part in (raw.where("volume % 2 = 0"), raw):
        sinks.materialize(PriceModels(part, wl_rows, calendar=None), root=root, names=names, versioned=True)
    return root


def rebuilt_price_facts(spark, sf_dir):
    """The price facts that a reader finds after a rebuild."""
    root = _rebuilt(spark, sf_dir, ["dim_ticker", "fact_stock_price_daily"])
    return versions.read(spark, f"{root}/MARTS", "fact_stock_price_daily")


def rebuilt_staging_view(spark, sf_dir):
    """A view of the staging layer, by the name it is registered under."""
    m = feed_a(spark, sf_dir)
    return spark.table(sinks.materialize(m, names=["stg_market__tickers"], share_intermediates=False)["stg_market__tickers"])


QUERIES.update({
    "landed_append_repeated": landed_append_repeated,
    "rebuilt_price_facts": rebuilt_price_facts,
    "rebuilt_staging_view": rebuilt_staging_view,
})


# -- landed increments -----------------------------------------------------------------

def _landed_parts(spark, sf_dir):
    """Feed A's rows as a first load and what was landed later: a fifth of the
    loads (dates the base holds already, and new ones) and one late year."""
    from tickspan.plans.staging import renamed_prices
    rows = renamed_prices(testfeeds.feed_a_raw_prices(spark, sf_dir))
    late = (F.pmod(F.unix_timestamp(F.col("loaded_at").cast("timestamp")), F.lit(5)) == 0) | (F.year("trading_date") == 1998)
    return rows.where(~late), rows.where(late)


def dedup_base_and_landed(spark, sf_dir):
    """A compacted base read together with rows landed since."""
    from tickspan.plans.staging import dedup_order, stage_renamed
    base, landed = _landed_parts(spark, sf_dir)
    base = spark.read.parquet(_written(stage_renamed(base), "base", "parquet"))
    return increments.merged_latest(base, landed.select(*base.columns), dedup_order())


def indicators_incremental(spark, sf_dir):
    """Stored indicators of the base, brought up to date with rows landed since."""
    from tickspan.plans.staging import dedup_order, stage_renamed
    base, landed = _landed_parts(spark, sf_dir)
    stored = spark.read.parquet(_written(daily_indicators(stage_renamed(base)), "indicators", "parquet"))
    return _round(increments.refreshed_indicators(stored, landed, dedup_order()), _VOL, VOL_DIGITS)


def indicators_appended(spark, sf_dir):
    """Indicators of the years from 1997 on, from stored tails and new rows alone,
    after those of the years before."""
    from tickspan.plans.staging import renamed_prices, stage_renamed
    staged = stage_renamed(renamed_prices(testfeeds.feed_a_raw_prices(spark, sf_dir)))
    old = daily_indicators(staged.where(F.year("trading_date") < 1997))
    tail = spark.read.parquet(_written(increments.tails(old), "tails", "parquet"))
    made = increments.appended_indicators(tail, staged.where(F.year("trading_date") >= 1997))
    return _round(old.unionByName(made), _VOL, VOL_DIGITS)


QUERIES.update({
    "dedup_base_and_landed": dedup_base_and_landed,
    "indicators_incremental": indicators_incremental,
    "indicators_appended": indicators_appended,
})

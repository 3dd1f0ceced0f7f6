"""Per-ticker analytics of the watchlist page, for every ticker at once.

The page computes these for one selected ticker; here each is a DataFrame over
all tickers (or filtered to one with ``symbol=``). First / last rows of a
ticker's history are ``min_by`` / ``max_by`` aggregates: partial aggregation
runs map-side, so a ticker with a huge history is combined before the shuffle.
Cumulative returns ride on the per-ticker order the indicators already have.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickspan.functions import safe_divide
from tickspan.operators.joins import join_small
from tickspan.operators.periods import history_start

HISTORY_ORDER = ["ticker_symbol", "trading_date"]
HISTORY_COLUMNS = ["trading_date", "close_price", "moving_average_7d", "moving_average_20d",
                   "moving_average_50d", "daily_return_pct", "volume", "volatility_20d",
                   "annualized_volatility_20d"]

# Signal thresholds and the scenario amount.
HIGH_VOLATILITY = 0.30      # annualized volatility strictly above → flag
UNUSUAL_MOVE = 0.03         # |daily return| strictly above → flag
SCENARIO_AMOUNT = 10_000.0


def watchlist_listing(watchlist: DataFrame, include_inactive: bool = True) -> DataFrame:
    """Tickers, active first, then by symbol; ``include_inactive=False`` keeps
    active ones only."""
    if not include_inactive:
        watchlist = watchlist.where(F.col("is_active") == F.lit(True))
    return (watchlist.select("symbol", "company_name", "category", "notes", "is_active",
                             "created_at", "updated_at")
            .orderBy(F.col("is_active").desc(), F.col("symbol").asc()))


def active_symbols(watchlist: DataFrame, ordered: bool = True) -> DataFrame:
    df = watchlist.where(F.col("is_active") == F.lit(True)).select("symbol")
    return df.orderBy("symbol") if ordered else df


def ticker_history(mart: DataFrame, period: str = "ALL_AVAILABLE", symbol: str | None = None,
                   anchor_dates: DataFrame | None = None, numeric: bool = True,
                   ordered: bool = True) -> DataFrame:
    """Daily history (price, averages, return, volume, volatility) from
    ``period``'s start, ordered by date.

    The start comes from the latest date of the active-ticker mart (an
    uncorrelated scalar subquery; ``anchor_dates`` may supply the same dates
    more cheaply). With ``numeric`` every measure is coerced to double (NULL
    when not a number), as the page does."""
    src = anchor_dates if anchor_dates is not None else mart
    latest = src.select(F.max("trading_date")).scalar()
    start = history_start(period, latest)
    df = mart.where(F.col("trading_date") >= start)
    if "calendar_year" in mart.columns:
        # Implied by the date bound; on a mart partitioned by year it becomes
        # a partition filter, so earlier years are never read.
        df = df.where(F.col("calendar_year") >= F.year(start))
    if symbol is not None:
        df = df.where(F.col("ticker_symbol") == F.lit(symbol))
    cols = [F.col("ticker_symbol"), F.col("trading_date")]
    for c in HISTORY_COLUMNS[1:]:
        cols.append(F.col(c).try_cast("double").alias(c) if numeric else F.col(c))
    df = df.select(*cols)
    return df.orderBy(*HISTORY_ORDER) if ordered else df


def _last(cols: list[str], order: str = "trading_date") -> list[Column]:
    return [F.max_by(c, order).alias(c) for c in cols]


def latest_snapshot(history: DataFrame) -> DataFrame:
    """Latest row per ticker: price, daily return, averages, volatility."""
    cols = ["close_price", "daily_return_pct", "moving_average_20d", "annualized_volatility_20d"]
    return history.groupBy("ticker_symbol").agg(
        F.max("trading_date").alias("trading_date"), *_last(cols))


def signals(snapshot: DataFrame) -> DataFrame:
    """Signal flags from the latest row.

    ma20_signal: 'bullish' when close > 20-row mean, otherwise 'bearish'
    (equal counts as bearish); NULL when either value is missing or zero.
    high_volatility / unusual_move: strict comparisons; missing → false."""
    close, ma20 = F.col("close_price"), F.col("moving_average_20d")
    present = close.isNotNull() & ma20.isNotNull() & (close != 0) & (ma20 != 0)
    vol, ret = F.col("annualized_volatility_20d"), F.col("daily_return_pct")
    return snapshot.select(
        "ticker_symbol", "trading_date",
        F.when(present, F.when(close > ma20, F.lit("bullish")).otherwise(F.lit("bearish"))).alias("ma20_signal"),
        F.coalesce(vol > F.lit(HIGH_VOLATILITY), F.lit(False)).alias("high_volatility"),
        F.coalesce(F.abs(ret) > F.lit(UNUSUAL_MOVE), F.lit(False)).alias("unusual_move"),
    )


def period_endpoints(history: DataFrame) -> DataFrame:
    """Per ticker: first / last close of the history and its mean volume."""
    return history.groupBy("ticker_symbol").agg(
        F.min_by("close_price", "trading_date").alias("first_close"),
        F.max_by("close_price", "trading_date").alias("last_close"),
        F.avg("volume").alias("avg_daily_volume"),
        F.count(F.lit(1)).alias("trading_days"),
    )


def investment_scenario(history: DataFrame, amount: float = SCENARIO_AMOUNT) -> DataFrame:
    """Period return and the value of ``amount`` invested at the first close."""
    e = period_endpoints(history)
    first, last = F.col("first_close").cast("double"), F.col("last_close").cast("double")
    shares = safe_divide(F.lit(float(amount)), first)
    return e.select(
        "ticker_symbol", "first_close", "last_close",
        (safe_divide(last - first, first) * 100).alias("period_return_pct"),
        shares.alias("shares"),
        (shares * last).alias("end_value"),
        (shares * last - F.lit(float(amount))).alias("gain_loss"),
        "avg_daily_volume", "trading_days",
    )


def cumulative_returns(history: DataFrame) -> DataFrame:
    """(close / first close − 1) · 100 per row, each ticker based on its own
    first row. A window per ticker and date: the history comes from windows of the
    same partitioning and order, so this needs no exchange and no second read."""
    w = Window.partitionBy("ticker_symbol").orderBy("trading_date").rowsBetween(Window.unboundedPreceding, 0)
    return history.select("ticker_symbol", "trading_date",
                          ((safe_divide(F.col("close_price"), F.first("close_price").over(w)) - 1) * 100)
                          .alias("cumulative_return_pct"))


def benchmark_comparison(history: DataFrame, benchmark: str | Column | None = None,
                         series_rows: int | None = None) -> DataFrame:
    """Cumulative return of every ticker next to a benchmark ticker's, on the
    dates both have.

    ``benchmark``: a symbol or Column (the benchmark itself is then not
    compared with itself), or ``None`` for the page's default: the first
    symbol in order other than the ticker – the first symbol for every ticker
    but itself, which gets the second.

    The history is read once: cumulative returns (three columns a row) are
    checkpointed, and the symbols, the benchmark series and the rows all come from
    there. The series are at most two tickers over one period (``series_rows``
    dates each), joined on (date, benchmark) behind that bound or a size check."""
    from tickspan.session import cut_lineage
    cum = cut_lineage(cumulative_returns(history))
    if benchmark is None:
        first = cum.select(F.min("ticker_symbol")).scalar()
        second = cum.where(F.col("ticker_symbol") > first).select(F.min("ticker_symbol")).scalar()
        choice = F.when(F.col("ticker_symbol") == first, second).otherwise(first)
        bench_filter = F.col("ticker_symbol").isin(first, second)
    else:
        bsym = F.lit(benchmark) if isinstance(benchmark, str) else benchmark
        choice = F.when(F.col("ticker_symbol") != bsym, bsym)
        bench_filter = F.col("ticker_symbol") == bsym
    bench = cum.where(bench_filter).select(F.col("ticker_symbol").alias("benchmark_symbol"), "trading_date",
                                           F.col("cumulative_return_pct").alias("benchmark_cumulative_return_pct"))
    mine = cum.select("ticker_symbol", choice.alias("benchmark_symbol"), "trading_date",
                      F.col("cumulative_return_pct").alias("ticker_cumulative_return_pct"))
    # A full outer join followed by dropping incomplete rows equals an inner join.
    bound = 2 * series_rows if series_rows is not None else None
    return join_small(mine, bench, ["trading_date", "benchmark_symbol"], "inner",
                      known_rows=bound).select(
        "ticker_symbol", "benchmark_symbol", "trading_date",
        "ticker_cumulative_return_pct", "benchmark_cumulative_return_pct")


def chart_series(history: DataFrame) -> DataFrame:
    """Price and moving averages under the chart's series names."""
    return history.select("ticker_symbol", "trading_date",
                          F.col("close_price").alias("Close"),
                          F.col("moving_average_7d").alias("MA 7d"),
                          F.col("moving_average_20d").alias("MA 20d"),
                          F.col("moving_average_50d").alias("MA 50d"))


def summary_display(summary: DataFrame) -> DataFrame:
    """The period summary as display strings under the table's headers."""
    from tickspan.functions import currency, percent, signed_percent, whole_number
    from tickspan.operators.periods import period_rank
    return summary.select(
        "ticker_symbol", period_rank().alias("period_rank"),
        F.col("period_name").alias("Period"),
        F.col("period_start_date").alias("Start"),
        F.col("period_end_date").alias("End"),
        currency("start_close_price").alias("Start Price"),
        currency("end_close_price").alias("End Price"),
        signed_percent("period_return_pct", 2).alias("Total Return"),
        signed_percent("avg_daily_return_pct", 4).alias("Avg Daily Return"),
        percent("volatility_pct", 2).alias("Volatility"),
        F.col("min_close_price").cast("double").alias("Min Price"),
        F.col("max_close_price").cast("double").alias("Max Price"),
        whole_number("avg_volume").alias("Avg Volume"),
        F.col("trading_days_count").alias("Trading Days"),
    )


def ordered_summary(summary: DataFrame, symbol: str | None = None) -> DataFrame:
    """Summary rows with the display rank (MTD first … ALL_AVAILABLE last),
    measures coerced to double as the page does."""
    from tickspan.operators.periods import period_rank
    df = summary if symbol is None else summary.where(F.col("ticker_symbol") == F.lit(symbol))
    num = ["start_close_price", "end_close_price", "period_return_pct", "avg_daily_return_pct",
           "volatility_pct", "min_close_price", "max_close_price", "avg_volume", "trading_days_count"]
    return df.select("ticker_symbol", period_rank().alias("period_rank"), "period_name",
                     "period_start_date", "period_end_date",
                     *[F.col(c).try_cast("double").alias(c) for c in num]
                     ).orderBy("ticker_symbol", "period_rank")

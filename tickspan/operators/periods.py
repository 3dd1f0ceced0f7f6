"""Period anchors, period definitions and the per-ticker period summary.

The six reporting periods share one end (the latest date) and differ by start:

    ALL_AVAILABLE  [earliest, latest]      YTD  [1 Jan of latest year, latest]
    MTD            [1st of latest month]   30D  [latest - 29 days, latest]
    90D            [latest - 89 days]      1Y   [latest - 1 year, latest]

Anchors are global (one max/min over all rows), evaluated once as uncorrelated
scalar subqueries: no join, no cross product. The periods share their end, so
they are nested: a row belongs to the periods of all starts up to its date and
is aggregated once, into the cell of its narrowest period. A ticker has at most
six cells, whose sums, minima, maxima and boundary rows merge; merged from the
narrowest outward they give every period. No row is multiplied, and a hot ticker
is combined map-side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickspan.functions import month_start, one_year_before, safe_divide, year_start
from tickspan.operators.joins import join_small

# Period names and the display rank used to order a summary.
PERIOD_RANK = {"MTD": 1, "30D": 2, "90D": 3, "YTD": 4, "1Y": 5, "ALL_AVAILABLE": 6}
PERIOD_NAMES = ["ALL_AVAILABLE", "YTD", "MTD", "30D", "90D", "1Y"]


def period_starts(latest: Column, earliest: Column) -> dict[str, Column]:
    """Nominal start of each period given the latest / earliest dates."""
    return {
        "ALL_AVAILABLE": earliest,
        "YTD": year_start(latest),
        "MTD": month_start(latest),
        "30D": F.date_sub(latest, 29),
        "90D": F.date_sub(latest, 89),
        "1Y": one_year_before(latest),
    }


def history_start(period: str, latest: Column) -> Column:
    """Lower bound used by the ticker-history view: MTD is not offered there,
    and ALL_AVAILABLE or an unknown period means no bound (1900-01-01)."""
    starts = {"30D": F.date_sub(latest, 29), "90D": F.date_sub(latest, 89),
              "YTD": year_start(latest), "1Y": one_year_before(latest)}
    return starts.get(period, F.lit("1900-01-01").cast("date"))


def anchors(perf: DataFrame, date_col: str = "trading_date") -> DataFrame:
    """One row: latest_date and the six period starts."""
    agg = perf.agg(F.max(date_col).alias("latest_date"), F.min(date_col).alias("start_all"))
    s = period_starts(F.col("latest_date"), F.col("start_all"))
    return agg.select("latest_date",
                      s["30D"].alias("start_30d"), s["90D"].alias("start_90d"),
                      s["YTD"].alias("start_ytd"), s["MTD"].alias("start_mtd"),
                      s["1Y"].alias("start_1y"), "start_all")


def _period_array(latest: Column, earliest: Column) -> Column:
    starts = period_starts(latest, earliest)
    return F.array(*[
        F.struct(F.lit(name).alias("period_name"), starts[name].alias("period_start"),
                 latest.alias("period_end"))
        for name in PERIOD_NAMES])


def period_definitions(perf: DataFrame, date_col: str = "trading_date") -> DataFrame:
    """Six rows (period_name, period_start, period_end) from one aggregate."""
    agg = perf.agg(F.max(date_col).alias("l"), F.min(date_col).alias("e"))
    return agg.select(F.inline(_period_array(F.col("l"), F.col("e"))))


def nested_cell(date_col: str, latest: Column, starts: dict[str, Column]) -> Column:
    """How many of the periods hold a row (0: none). Periods are nested, so the
    number tells which."""
    d = F.col(date_col)
    held = sum((F.when(d >= s, 1).otherwise(0) for s in starts.values()), F.lit(0))
    return F.when(d <= latest, held).otherwise(0)


def period_summary(perf: DataFrame, tickers: DataFrame,
                   anchor_dates: DataFrame | None = None, ticker_rows: int | None = None) -> DataFrame:
    """Per (ticker, period) summary.

    ``perf``: ticker_symbol, trading_date, close_price, daily_return_pct,
    volatility_20d, volume (one row per ticker and date).
    ``tickers``: ticker_symbol, company_name, category.
    ``anchor_dates``: optional cheaper relation with the same trading dates.

    period_start/end_date are the ticker's actual first/last dates in the
    period; volatility_pct is the mean of the rolling 20-row volatility; a
    ticker with no row in a period has no row for it.
    """
    src = (anchor_dates if anchor_dates is not None else perf).select(F.max("trading_date").alias("l"), F.min("trading_date").alias("e"))
    latest, earliest = src.select("l").scalar(), src.select("e").scalar()
    starts = period_starts(latest, earliest)
    rows = perf.select("ticker_symbol", "trading_date", "close_price", "daily_return_pct", "volatility_20d", "volume",
                       nested_cell("trading_date", latest, starts).alias("_cell")).where(F.col("_cell") > 0)
    cells = rows.groupBy("ticker_symbol", "_cell").agg(
        F.min("trading_date").alias("period_start_date"),
        F.max("trading_date").alias("_end_date"),
        F.min_by("close_price", "trading_date").alias("start_close_price"),
        F.max_by("close_price", "trading_date").alias("_end_close"),
        F.sum("daily_return_pct").alias("_returns"), F.count("daily_return_pct").alias("_n_returns"),
        F.sum("volatility_20d").alias("_vol"), F.count("volatility_20d").alias("_n_vol"),
        F.min("close_price").alias("_min_close"), F.max("close_price").alias("_max_close"),
        F.sum("volume").alias("_volume"), F.count("volume").alias("_n_volume"),
        F.count("trading_date").alias("_n"),
    )
    # From the narrowest cell outward: a cell's first row is its period's, the
    # last row is the narrowest cell's, the rest accumulates.
    outward = Window.partitionBy("ticker_symbol").orderBy(F.col("_cell").desc())
    upto = outward.rowsBetween(Window.unboundedPreceding, 0)

    def mean(total: str, n: str) -> Column:
        return F.sum(total).over(upto).cast("double") / F.nullif(F.sum(n).over(upto), F.lit(0))
    merged = cells.select(
        "ticker_symbol", "_cell", "period_start_date", "start_close_price",
        F.first("_end_date").over(upto).alias("period_end_date"), F.first("_end_close").over(upto).alias("end_close_price"),
        mean("_returns", "_n_returns").alias("avg_daily_return_pct"), mean("_vol", "_n_vol").alias("volatility_pct"),
        F.min("_min_close").over(upto).alias("min_close_price"), F.max("_max_close").over(upto).alias("max_close_price"),
        mean("_volume", "_n_volume").alias("avg_volume"), F.sum("_n").over(upto).alias("trading_days_count"),
        F.coalesce(F.lead("_cell").over(outward), F.lit(0)).alias("_next"))
    # A period needs every cell of at least as many periods as start no later than it.
    needs = {p: sum((F.when(other <= start, 1).otherwise(0) for other in starts.values()), F.lit(0)) for p, start in starts.items()}
    names = F.array_compact(F.array(*[F.when((needs[p] <= F.col("_cell")) & (needs[p] > F.col("_next")), F.lit(p)) for p in PERIOD_NAMES]))
    g = merged.select("*", F.explode(names).alias("period_name"))
    t = tickers.select("ticker_symbol", "company_name", "category")
    j = join_small(g, t, "ticker_symbol", "inner", known_rows=ticker_rows)
    return j.select(
        "ticker_symbol", "company_name", "category", "period_name",
        "period_start_date", "period_end_date", "start_close_price", "end_close_price",
        safe_divide(F.col("end_close_price") - F.col("start_close_price"),
                    F.col("start_close_price")).alias("period_return_pct"),
        "avg_daily_return_pct", "volatility_pct", "min_close_price", "max_close_price",
        "avg_volume", "trading_days_count",
    )


def period_rank(col: str = "period_name") -> Column:
    """Display order of periods (MTD first, ALL_AVAILABLE last)."""
    expr = F.lit(None).cast("int")
    for name, rank in PERIOD_RANK.items():
        expr = F.when(F.col(col) == name, F.lit(rank)).otherwise(expr)
    return expr

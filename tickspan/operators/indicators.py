"""Per-ticker daily indicators in one window pass.

Returns, 7/20/50-row moving averages and 20-row rolling volatility share the
(ticker, date) grain, so they are computed together over one partitioning and
one sort instead of three models joined back on (ticker, date).

Partitioning: by default the windows run per ticker. Input rows are unique per
(ticker, date), so one ticker's partition holds at most one row per calendar
day of the data's span – a bound set by the calendar, not by data volume (a
century of daily bars is ≈ 36.6k rows). Copies of a hot (ticker, date) are cut
down before the shuffle by the dedup's map-side group limit.

Where that bound is too large (bars finer than a day) ``split_by_year=True``
removes it:
every frame here is bounded (at most 49 preceding rows), so a ticker's
history can be cut into calendar-year buckets. The windows run per (ticker,
year); rows from the 50th of their year on are exact as they are, and the
first 49 rows of each year are recomputed together with the 49 rows that
precede the year (its *halo*), whose copies are then dropped. Results are
exact, and no window task ever holds more than one ticker-year (plus 49 rows),
however many rows one ticker has.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from tickspan.functions import safe_divide

# Fixed window lengths (rows, not calendar days) and the annualisation factor.
MA_SHORT, MA_MEDIUM, MA_LONG = 7, 20, 50
VOL_ROWS = 20
TRADING_DAYS_PER_YEAR = 252
# Preceding rows any indicator can reach: the 50-row mean needs 49; the 20-row
# volatility needs 19 returns, each needing one earlier close (20 rows).
HALO_ROWS = max(MA_LONG - 1, VOL_ROWS)

MA_FRAMES = {MA_SHORT: "moving_average_7d", MA_MEDIUM: "moving_average_20d", MA_LONG: "moving_average_50d"}

_BUCKET, _IS_HALO, _POS, _CNT = "_bucket", "_is_halo", "_pos", "_cnt"
_SUM, _N = "_sum", "_n"


def _year_bucket(date_col: str = "trading_date"):
    return F.year(F.col(date_col))


def halo_rows(d: DataFrame, key: str = "ticker_symbol", halo: int = HALO_ROWS) -> DataFrame:
    """For rows already numbered within their (key, bucket) – ``_pos`` from 1,
    ``_cnt`` the bucket size – return, for every bucket, copies of the
    ``halo`` rows that directly precede it, re-labelled with that bucket and
    flagged ``_is_halo``.

    Only bucket sizes (keys × years rows) and at most ``halo`` tail rows per
    bucket travel; the bulk of the data is not copied.
    """
    tail = d.where(F.col(_POS) > F.col(_CNT) - halo).withColumn("_r", F.col(_CNT) - F.col(_POS) + 1)
    # Sizes come from the last row of each bucket (itself a tail row), so they
    # need no pass of their own over the data.
    sizes = tail.where(F.col("_r") == 1).select(key, _BUCKET, F.col(_CNT).alias("_n"))
    # Earlier buckets that reach into the `halo` rows before bucket b: at most
    # `halo` of them, because every bucket holds at least one row.
    wb = Window.partitionBy(key).orderBy(_BUCKET).rowsBetween(-halo, -1)
    prev = F.array_sort(F.collect_list(F.struct(F.col(_BUCKET).alias("b"), F.col("_n").alias("n"))).over(wb))
    # gap(a, b) = rows in the buckets strictly between a and b.
    gaps = F.transform(
        F.col("_prev"),
        lambda x, i: F.struct(
            x["b"].alias("src"),
            F.aggregate(F.slice(F.col("_prev"), i + 2, F.greatest(F.size("_prev") - i - 1, F.lit(0))),
                        F.lit(0).cast("long"), lambda acc, y: acc + y["n"]).alias("gap")))
    targets = (sizes.select(key, _BUCKET, prev.alias("_prev"))
               .select(key, F.col(_BUCKET).alias("_dst"), F.explode(gaps).alias("_t"))
               .select(key, "_dst", F.col("_t.src").alias(_BUCKET), F.col("_t.gap").alias("_gap"))
               .where(F.col("_gap") < halo))
    return (tail.join(targets, [key, _BUCKET])
            .where(F.col("_r") + F.col("_gap") <= halo)
            .withColumn(_BUCKET, F.col("_dst"))
            .withColumn(_IS_HALO, F.lit(True)))


def _with_indicators(df: DataFrame, w) -> DataFrame:
    """Means come from running sums: the sum of a frame is the running sum less
    that of the row before the frame. Decimal sums are exact, so the difference is
    the frame's own sum, and a row costs two terms a mean however long the frame
    (a moving frame adds up all its rows anew for every row)."""
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    df = df.select(
        "*",
        F.lag("close_price").over(w).alias("previous_close_price"),
        F.coalesce(F.sum("close_price").over(upto), F.lit(0)).alias(_SUM),
        F.count("close_price").over(upto).alias(_N),
    )
    df = df.select(
        "*",
        (F.col("close_price") - F.col("previous_close_price")).alias("price_change"),
        safe_divide(F.col("close_price") - F.col("previous_close_price"),
                    F.col("previous_close_price")).alias("daily_return_pct"),
    )
    # Second window over the same partitioning and order: no extra exchange/sort.
    df = df.select(
        "*",
        *[(F.col(_SUM) - F.coalesce(F.lag(_SUM, n).over(w), F.lit(0))).alias(f"{_SUM}{n}") for n in MA_FRAMES],
        *[(F.col(_N) - F.coalesce(F.lag(_N, n).over(w), F.lit(0))).alias(f"{_N}{n}") for n in MA_FRAMES],
        F.stddev_samp("daily_return_pct").over(w.rowsBetween(-(VOL_ROWS - 1), 0)).alias("volatility_20d"))
    # The stddev is evaluated once; annualising is a plain projection.
    return df.select(
        "*",
        *[safe_divide(f"{_SUM}{n}", f"{_N}{n}").alias(name) for n, name in MA_FRAMES.items()],
        (F.col("volatility_20d") * F.lit(math.sqrt(TRADING_DAYS_PER_YEAR))).alias("annualized_volatility_20d"))


INDICATOR_COLUMNS = ["previous_close_price", "price_change", "daily_return_pct",
                     "moving_average_7d", "moving_average_20d", "moving_average_50d",
                     "volatility_20d", "annualized_volatility_20d"]


def daily_indicators(prices: DataFrame, split_by_year: bool = False,
                     share_numbered: bool = True) -> DataFrame:
    """Staged prices (ticker_symbol, trading_date, open/high/low/close_price,
    volume) → one row per input row with

    previous_close_price, price_change, daily_return_pct (a fraction),
    moving_average_7d/20d/50d, volatility_20d (sample stddev of the last 20
    returns), annualized_volatility_20d.

    Windows count rows, not days: the previous row is the previous trading row
    even across gaps, and short early frames are kept. Returns are NULL on the
    first row (and when the previous close is 0); volatility is NULL on the
    first two rows (a sample stddev needs two returns).

    With ``split_by_year`` the windows run per (ticker, year): one shuffle of
    the data, as for per-ticker windows. Rows from the 50th of their year on
    see only rows of that year, so their values are already exact; the first
    49 rows of each year are recomputed together with their halo (the 49 rows
    before the year) in a second, small pass, and the two parts are
    concatenated without a further shuffle.
    """
    key, day = "ticker_symbol", "trading_date"
    out = list(prices.columns) + INDICATOR_COLUMNS
    if not split_by_year:
        return _with_indicators(prices, Window.partitionBy(key).orderBy(day)).select(*out)

    wb = Window.partitionBy(key, _BUCKET).orderBy(day)
    # Position as a running count (dates are unique per ticker): unlike
    # row_number it is not rewritten into a group limit below the exchange.
    d = (prices.withColumn(_BUCKET, _year_bucket(day))
         .withColumn(_POS, F.count(F.lit(1)).over(wb.rowsBetween(Window.unboundedPreceding, 0)))
         .withColumn(_CNT, F.count(F.lit(1)).over(Window.partitionBy(key, _BUCKET))))
    # The windows of a year run where its rows are numbered, on the same sort;
    # what the first rows of a year lack is not kept.
    exact = F.col(_POS) > HALO_ROWS
    d = _with_indicators(d, wb).select(*prices.columns, *[F.when(exact, F.col(c)).alias(c) for c in INDICATOR_COLUMNS],
                                       _BUCKET, _POS, _CNT)
    if share_numbered:
        # Body, head and tail branches all read `d`; Spark would recompute it
        # (dedup and the bucket shuffle) per branch, so write it once to the
        # shared checkpoint folder instead.
        from tickspan.session import stored
        d = stored(d, "year-buckets")
    body = d.where(F.col(_POS) > HALO_ROWS).select(*out)
    numbered = d.drop(*INDICATOR_COLUMNS)
    head = numbered.where(F.col(_POS) <= HALO_ROWS).withColumn(_IS_HALO, F.lit(False))
    ctx = halo_rows(numbered, key).select(*head.columns)
    head_done = _with_indicators(head.unionByName(ctx), wb).where(~F.col(_IS_HALO)).select(*out)
    return body.unionByName(head_done)

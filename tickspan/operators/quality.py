"""Data-quality checks. Each check returns the *violating* rows (empty =
pass); ``run_suite`` returns one row per check with its failure count.

NULL handling follows the usual generic-test rules: ``unique`` and
``relationships`` ignore NULL keys, ``accepted_values`` lets NULL pass.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import DataFrame, Observation, functions as F

from tickspan.operators.joins import join_small

# ---------------------------------------------------------------------------
# The declared tests (model, column, test, argument).
# ---------------------------------------------------------------------------
PERIODS = ["ALL_AVAILABLE", "YTD", "MTD", "30D", "90D", "1Y"]
DECLARED_TESTS = [
    ("stg_market__stock_prices", "ticker_symbol", "not_null", None),
    ("stg_market__stock_prices", "trading_date", "not_null", None),
    ("stg_market__stock_prices", "open_price", "not_null", None),
    ("stg_market__stock_prices", "high_price", "not_null", None),
    ("stg_market__stock_prices", "low_price", "not_null", None),
    ("stg_market__stock_prices", "close_price", "not_null", None),
    ("stg_market__stock_prices", "volume", "not_null", None),
    ("stg_market__stock_prices", "data_source", "not_null", None),
    ("stg_market__stock_prices", "data_source", "accepted_values", ["alpha_vantage"]),
    ("stg_market__tickers", "ticker_id", "not_null", None),
    ("stg_market__tickers", "ticker_id", "unique", None),
    ("stg_market__tickers", "ticker_symbol", "not_null", None),
    ("stg_market__tickers", "ticker_symbol", "unique", None),
    ("stg_market__tickers", "is_active", "not_null", None),
    ("int_stock_daily_returns", "ticker_symbol", "not_null", None),
    ("int_stock_daily_returns", "trading_date", "not_null", None),
    ("int_stock_daily_returns", "close_price", "not_null", None),
    ("int_stock_moving_averages", "ticker_symbol", "not_null", None),
    ("int_stock_moving_averages", "trading_date", "not_null", None),
    ("int_stock_moving_averages", "close_price", "not_null", None),
    ("int_stock_volatility", "ticker_symbol", "not_null", None),
    ("int_stock_volatility", "trading_date", "not_null", None),
    ("dim_ticker", "ticker_key", "not_null", None),
    ("dim_ticker", "ticker_key", "unique", None),
    ("dim_ticker", "ticker_symbol", "not_null", None),
    ("dim_ticker", "ticker_symbol", "unique", None),
    ("dim_ticker", "is_active", "not_null", None),
    ("dim_date", "date_key", "not_null", None),
    ("dim_date", "date_key", "unique", None),
    ("dim_date", "date_day", "not_null", None),
    ("dim_date", "date_day", "unique", None),
    ("dim_date", "calendar_year", "not_null", None),
    ("dim_date", "calendar_quarter", "not_null", None),
    ("dim_date", "calendar_month", "not_null", None),
    ("dim_date", "is_weekend", "not_null", None),
    ("dim_date", "is_weekday", "not_null", None),
    ("dim_date", "is_market_holiday", "not_null", None),
    ("dim_date", "is_trading_day", "not_null", None),
    ("fact_stock_price_daily", "ticker_symbol", "not_null", None),
    ("fact_stock_price_daily", "ticker_symbol", "relationships", ("dim_ticker", "ticker_symbol")),
    ("fact_stock_price_daily", "ticker_key", "not_null", None),
    ("fact_stock_price_daily", "date_key", "not_null", None),
    ("fact_stock_price_daily", "date_key", "relationships", ("dim_date", "date_key")),
    ("fact_stock_price_daily", "trading_date", "not_null", None),
    ("fact_stock_price_daily", "open_price", "not_null", None),
    ("fact_stock_price_daily", "high_price", "not_null", None),
    ("fact_stock_price_daily", "low_price", "not_null", None),
    ("fact_stock_price_daily", "close_price", "not_null", None),
    ("fact_stock_price_daily", "volume", "not_null", None),
    ("fact_stock_performance_daily", "ticker_symbol", "not_null", None),
    ("fact_stock_performance_daily", "ticker_symbol", "relationships", ("dim_ticker", "ticker_symbol")),
    ("fact_stock_performance_daily", "ticker_key", "not_null", None),
    ("fact_stock_performance_daily", "date_key", "not_null", None),
    ("fact_stock_performance_daily", "date_key", "relationships", ("dim_date", "date_key")),
    ("fact_stock_performance_daily", "trading_date", "not_null", None),
    ("fact_stock_performance_daily", "close_price", "not_null", None),
    ("mart_watchlist_performance", "ticker_symbol", "not_null", None),
    ("mart_watchlist_performance", "is_active", "not_null", None),
    ("mart_watchlist_performance", "trading_date", "not_null", None),
    ("mart_watchlist_performance", "close_price", "not_null", None),
    ("mart_watchlist_performance", "volume", "not_null", None),
    ("mart_ticker_performance_summary", "ticker_symbol", "not_null", None),
    ("mart_ticker_performance_summary", "period_name", "not_null", None),
    ("mart_ticker_performance_summary", "period_name", "accepted_values", PERIODS),
    ("mart_ticker_performance_summary", "period_start_date", "not_null", None),
    ("mart_ticker_performance_summary", "period_end_date", "not_null", None),
    ("mart_ticker_performance_summary", "trading_days_count", "not_null", None),
]

# Grain checks that are claimed but not declared: one row per key set.
GRAIN_TESTS = [
    ("stg_market__stock_prices", ("ticker_symbol", "trading_date")),
    ("fact_stock_price_daily", ("ticker_symbol", "trading_date")),
    ("fact_stock_performance_daily", ("ticker_symbol", "trading_date")),
    ("mart_watchlist_performance", ("ticker_symbol", "trading_date")),
    ("mart_ticker_performance_summary", ("ticker_symbol", "period_name")),
]


# -- single checks (violating rows) ------------------------------------------------

def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNull())


def unique(df: DataFrame, col: str | tuple | list) -> DataFrame:
    """Key values (NULLs ignored) that occur more than once, with their count.
    A partial count runs before the shuffle, so a hot key costs one row per
    map task."""
    cols = [col] if isinstance(col, str) else list(col)
    nn = df
    for c in cols:
        nn = nn.where(F.col(c).isNotNull())
    return nn.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1)


def accepted_values(df: DataFrame, col: str, values: list) -> DataFrame:
    """Distinct values outside ``values`` (NULL passes), with their count."""
    return (df.groupBy(F.col(col).alias("value_field")).agg(F.count(F.lit(1)).alias("n_records"))
            .where(~F.col("value_field").isin(list(values))))


def relationships(child: DataFrame, col: str, parent: DataFrame, field: str) -> DataFrame:
    """Child rows whose non-NULL ``col`` has no ``field`` in ``parent``."""
    keys = parent.select(F.col(field).alias(col)).where(F.col(col).isNotNull())
    return join_small(child.where(F.col(col).isNotNull()), keys, col, "left_anti")


def grain(df: DataFrame, cols) -> DataFrame:
    return unique(df, tuple(cols))


# -- suites (one row per check) ---------------------------------------------------

_RESULT_COLS = ["model", "column_name", "test", "failures"]


def _row(model, column, test, failures):
    return F.struct(F.lit(model).alias("model"), F.lit(column).alias("column_name"),
                    F.lit(test).alias("test"), failures.cast("bigint").alias("failures"))


def not_null_suite(models, tests=DECLARED_TESTS) -> DataFrame:
    """Every ``not_null`` check, one aggregate pass per model."""
    by_model = defaultdict(list)
    for m, c, t, _ in tests:
        if t == "not_null":
            by_model[m].append(c)
    parts = []
    for m, cols in by_model.items():
        agg = models.model(m).agg(*[F.count_if(F.col(c).isNull()).alias(f"_{i}") for i, c in enumerate(cols)])
        parts.append(agg.select(F.inline(F.array(*[_row(m, c, "not_null", F.col(f"_{i}"))
                                                   for i, c in enumerate(cols)]))))
    return _union(parts)


def unique_suite(models, tests=DECLARED_TESTS) -> DataFrame:
    parts = [unique(models.model(m), c).agg(F.count(F.lit(1)).alias("_f"))
             .select(F.inline(F.array(_row(m, c, "unique", F.col("_f")))))
             for m, c, t, _ in tests if t == "unique"]
    return _union(parts)


def accepted_suite(models, tests=DECLARED_TESTS) -> DataFrame:
    parts = [accepted_values(models.model(m), c, a).agg(F.count(F.lit(1)).alias("_f"))
             .select(F.inline(F.array(_row(m, c, "accepted_values", F.col("_f")))))
             for m, c, t, a in tests if t == "accepted_values"]
    return _union(parts)


def relationships_suite(models, tests=DECLARED_TESTS) -> DataFrame:
    parts = [relationships(models.model(m), c, models.model(a[0]), a[1]).agg(F.count(F.lit(1)).alias("_f"))
             .select(F.inline(F.array(_row(m, c, "relationships", F.col("_f")))))
             for m, c, t, a in tests if t == "relationships"]
    return _union(parts)


def grain_suite(models, tests=GRAIN_TESTS) -> DataFrame:
    parts = [grain(models.model(m), cols).agg(F.count(F.lit(1)).alias("_f"))
             .select(F.inline(F.array(_row(m, ",".join(cols), "unique_grain", F.col("_f")))))
             for m, cols in tests]
    return _union(parts)


class Watch:
    """Checks made while tables are written: every ``not_null`` and
    ``accepted_values`` check of a table is counted by the job that writes it
    (``DataFrame.observe`` right below the writer, where each partition counts
    once), so those checks read nothing again."""

    def __init__(self, tests=DECLARED_TESTS):
        self.tests, self.seen = tests, {}

    def attach(self, name: str, df: DataFrame) -> DataFrame:
        own = [t for t in self.tests if t[0] == name and t[2] in ("not_null", "accepted_values")]
        if not own:
            return df
        metrics = []
        for i, (_, col, test, arg) in enumerate(own):
            bad = F.col(col).isNull() if test == "not_null" else ~F.col(col).isin(list(arg))
            metrics.append(F.count_if(F.coalesce(bad, F.lit(False))).alias(f"_{i}"))
        seen = Observation()
        self.seen[name] = (own, seen)
        return df.observe(seen, *metrics)

    def results(self, models) -> DataFrame:
        """One row per check of the watched tables. A column that holds values
        it may not is counted by distinct value, as the suite does: only that
        column is read again."""
        rows, again = [], []
        for own, seen in self.seen.values():
            counts = seen.get
            for i, test in enumerate(own):
                n = counts[f"_{i}"]
                if n and test[2] == "accepted_values":
                    again.append(test)
                else:
                    rows.append((test[0], test[1], test[2], n))
        out = models.spark.createDataFrame(rows, "model string, column_name string, test string, failures long")
        return _union([out, accepted_suite(models, again)] if again else [out])


def run_suite(models, names=None, watch: Watch | None = None) -> DataFrame:
    """All declared checks plus the grain checks, of every model or of ``names``;
    those that ``watch`` made while writing are taken from there."""
    tests = [t for t in DECLARED_TESTS if names is None or t[0] in names]
    grains = [t for t in GRAIN_TESTS if names is None or t[0] in names]
    seen = set(watch.seen) if watch else set()
    scanned = [t for t in tests if not (t[0] in seen and t[2] in ("not_null", "accepted_values"))]
    parts = [watch.results(models)] if seen else []
    for suite, kind in ((not_null_suite, "not_null"), (unique_suite, "unique"), (accepted_suite, "accepted_values"),
                        (relationships_suite, "relationships")):
        if any(t[2] == kind for t in scanned):
            parts.append(suite(models, scanned))
    return _union([*parts, *([grain_suite(models, grains)] if grains else [])])


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(*_RESULT_COLS)

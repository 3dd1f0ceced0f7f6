"""DuckDB SQL equal in meaning to each registered query, formulated
independently of the Spark plans: the three window models computed separately
and joined back, facts and marts as plain joins, each period's rows selected
on their own and combined with UNION ALL, boundary closes looked up by
correlated subqueries, the watchlist folded change by change in a recursive
query. Tables are
the provided parquet views."""

from __future__ import annotations

# Feed A: raw prices from lineitem (same mapping as sources.testfeeds).
RAW_A = """
raw_a AS (
    SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS symbol,
           CAST(l_shipdate AS DATE) AS trade_date,
           CAST(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS DOUBLE) AS open,
           CAST(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 + CAST(l_tax AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS DOUBLE) AS high,
           CAST(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS DOUBLE) AS low,
           l_extendedprice AS close,
           CAST(l_quantity AS BIGINT) AS volume,
           'alpha_vantage' AS source,
           TIMESTAMP '2002-01-01 00:00:00' + to_seconds(l_orderkey * 8 + l_linenumber) AS loaded_at
    FROM lineitem
)"""

WATCHLIST_A = """
watchlist_a AS (
    SELECT s.s_suppkey AS watchlist_id, 's' || CAST(s.s_suppkey AS VARCHAR) AS symbol,
           s.s_name AS company_name, n.n_name AS category, CAST(NULL AS VARCHAR) AS notes,
           s.s_acctbal > 0 AS is_active,
           TIMESTAMP '2002-01-01 00:00:00' AS created_at, TIMESTAMP '2002-01-01 00:00:00' AS updated_at
    FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
)"""


def stg_prices(raw: str) -> str:
    return f"""
stg AS (
    SELECT ticker_symbol, trading_date, open_price, high_price, low_price, close_price, volume, data_source, loaded_at
    FROM (
        SELECT *, row_number() OVER (
                   PARTITION BY ticker_symbol, trading_date
                   ORDER BY loaded_at DESC NULLS LAST, close_price DESC NULLS LAST, open_price DESC NULLS LAST,
                            high_price DESC NULLS LAST, low_price DESC NULLS LAST, volume DESC NULLS LAST,
                            data_source DESC NULLS LAST) AS rn
        FROM (
            SELECT symbol AS ticker_symbol, CAST(trade_date AS DATE) AS trading_date,
                   CAST(open AS DECIMAL(18,4)) AS open_price, CAST(high AS DECIMAL(18,4)) AS high_price,
                   CAST(low AS DECIMAL(18,4)) AS low_price, CAST(close AS DECIMAL(18,4)) AS close_price,
                   CAST(volume AS BIGINT) AS volume, source AS data_source, loaded_at
            FROM {raw}) r
    ) d
    WHERE rn = 1
)"""


# Three intermediate models, each its own window query over the staged rows.
RETURNS = """
returns AS (
    SELECT ticker_symbol, trading_date, open_price, high_price, low_price, close_price, volume,
           previous_close_price,
           close_price - previous_close_price AS price_change,
           CASE WHEN previous_close_price = 0 OR previous_close_price IS NULL THEN NULL
                ELSE CAST(close_price - previous_close_price AS DOUBLE) / CAST(previous_close_price AS DOUBLE)
           END AS daily_return_pct
    FROM (SELECT *, lag(close_price) OVER (PARTITION BY ticker_symbol ORDER BY trading_date) AS previous_close_price
          FROM stg) x
)"""

MOVING = """
moving AS (
    SELECT ticker_symbol, trading_date, close_price,
           CAST(sum(close_price) OVER (PARTITION BY ticker_symbol ORDER BY trading_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS DOUBLE)
             / count(close_price) OVER (PARTITION BY ticker_symbol ORDER BY trading_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS moving_average_7d,
           CAST(sum(close_price) OVER (PARTITION BY ticker_symbol ORDER BY trading_date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS DOUBLE)
             / count(close_price) OVER (PARTITION BY ticker_symbol ORDER BY trading_date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS moving_average_20d,
           CAST(sum(close_price) OVER (PARTITION BY ticker_symbol ORDER BY trading_date ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS DOUBLE)
             / count(close_price) OVER (PARTITION BY ticker_symbol ORDER BY trading_date ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS moving_average_50d
    FROM stg
)"""

VOLATILITY = """
volatility AS (
    SELECT ticker_symbol, trading_date, daily_return_pct,
           stddev_samp(daily_return_pct) OVER (PARTITION BY ticker_symbol ORDER BY trading_date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS volatility_20d,
           stddev_samp(daily_return_pct) OVER (PARTITION BY ticker_symbol ORDER BY trading_date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) * sqrt(252) AS annualized_volatility_20d
    FROM returns
)"""

STG_TICKERS = """
stg_tickers AS (
    SELECT watchlist_id AS ticker_id, upper(symbol) AS ticker_symbol, company_name, category, notes,
           is_active, created_at, updated_at
    FROM watchlist_a
)"""

DIM_TICKER = """
dim_ticker AS (
    SELECT ticker_id AS ticker_key, ticker_symbol, company_name,
           CAST(NULL AS VARCHAR) AS asset_type, CAST(NULL AS VARCHAR) AS exchange_code,
           CAST(NULL AS VARCHAR) AS sector, CAST(NULL AS VARCHAR) AS industry,
           'USD' AS currency, 'US' AS country, category, notes, is_active,
           created_at AS first_added_at, updated_at AS last_updated_at
    FROM stg_tickers
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


A_BASE = (RAW_A, stg_prices("raw_a"))

ORACLE_SQL = {
    "dedup_latest_prices": with_(*A_BASE) + "SELECT * FROM stg",
    "daily_returns": with_(*A_BASE, RETURNS) + "SELECT * FROM returns",
    "moving_averages": with_(*A_BASE, MOVING) + "SELECT * FROM moving",
    "rolling_volatility": with_(*A_BASE, RETURNS, VOLATILITY) +
        "SELECT ticker_symbol, trading_date, daily_return_pct, round(volatility_20d, 6) AS volatility_20d, "
        "round(annualized_volatility_20d, 6) AS annualized_volatility_20d FROM volatility",
    "stage_tickers": with_(WATCHLIST_A, STG_TICKERS) + "SELECT * FROM stg_tickers",
    "dim_ticker": with_(WATCHLIST_A, STG_TICKERS, DIM_TICKER) + "SELECT * FROM dim_ticker",
}


# -- calendar ------------------------------------------------------------------
from tickspan.sources.holidays import holidays_values_sql  # noqa: E402

# Feed B bars from events.
RAW_B = """
raw_b AS (
    SELECT 'U' || CAST(user_id AS VARCHAR) AS symbol, CAST(ts AS DATE) AS trade_date,
           arg_min(value, ts) AS open, max(value) AS high, min(value) AS low, arg_max(value, ts) AS close,
           count(*) AS volume, 'alpha_vantage' AS source, max(ts) AS loaded_at
    FROM events GROUP BY 1, 2
)"""

WATCHLIST_B = """
watchlist_b AS (
    SELECT CAST(NULL AS BIGINT) AS watchlist_id, symbol, CAST(NULL AS VARCHAR) AS company_name,
           CAST(NULL AS VARCHAR) AS category, CAST(NULL AS VARCHAR) AS notes, TRUE AS is_active,
           TIMESTAMP '2024-01-01 00:00:00' AS created_at, TIMESTAMP '2024-01-01 00:00:00' AS updated_at
    FROM (SELECT DISTINCT symbol FROM raw_b) s
)"""


def spine_years(date_expr: str, relation: str) -> str:
    """Whole calendar years covering the dates of a relation."""
    return f"""
spine AS (
    SELECT CAST(unnest(generate_series(CAST(date_trunc('year', min({date_expr})) AS TIMESTAMP),
                                       CAST(make_date(year(max({date_expr})), 12, 31) AS TIMESTAMP),
                                       INTERVAL 1 DAY)) AS DATE) AS date_day
    FROM {relation}
)"""


# The calendar without window functions: adjacent trading days and running
# counters are correlated lookups over the set of open days.
DIM_DATE = f"""
closed AS (
    SELECT holiday_date, holiday_name FROM {holidays_values_sql()}
    WHERE market_code = 'NYSE' AND is_full_day_closure = TRUE
),
flags AS (
    SELECT s.date_day, c.holiday_name, c.holiday_date IS NOT NULL AS is_market_holiday,
           isodow(s.date_day) >= 6 AS is_weekend
    FROM spine s LEFT JOIN closed c ON c.holiday_date = s.date_day
),
open_days AS (SELECT date_day FROM flags WHERE NOT is_weekend AND NOT is_market_holiday),
dim_date AS (
    SELECT CAST(strftime(f.date_day, '%Y%m%d') AS INTEGER) AS date_key,
           f.date_day,
           CAST(year(f.date_day) AS INTEGER) AS calendar_year,
           CAST(quarter(f.date_day) AS INTEGER) AS calendar_quarter,
           CAST(month(f.date_day) AS INTEGER) AS calendar_month,
           monthname(f.date_day) AS calendar_month_name,
           strftime(f.date_day, '%b') AS calendar_month_short_name,
           CAST(weekofyear(f.date_day) AS INTEGER) AS calendar_week,
           CAST(day(f.date_day) AS INTEGER) AS day_of_month,
           CAST(isodow(f.date_day) AS INTEGER) AS day_of_week,
           dayname(f.date_day) AS day_of_week_name,
           strftime(f.date_day, '%a') AS day_of_week_short_name,
           CAST(dayofyear(f.date_day) AS INTEGER) AS day_of_year,
           CAST(f.date_day - INTERVAL (isodow(f.date_day) - 1) DAY AS DATE) AS week_start_date,
           CAST(f.date_day + INTERVAL (7 - isodow(f.date_day)) DAY AS DATE) AS week_end_date,
           make_date(year(f.date_day), month(f.date_day), 1) AS month_start_date,
           last_day(f.date_day) AS month_end_date,
           make_date(year(f.date_day), 3 * ((month(f.date_day) - 1) // 3) + 1, 1) AS quarter_start_date,
           last_day(make_date(year(f.date_day), 3 * ((month(f.date_day) - 1) // 3) + 3, 1)) AS quarter_end_date,
           make_date(year(f.date_day), 1, 1) AS year_start_date,
           make_date(year(f.date_day), 12, 31) AS year_end_date,
           f.is_weekend,
           NOT f.is_weekend AS is_weekday,
           f.is_market_holiday,
           f.holiday_name AS market_holiday_name,
           NOT f.is_weekend AND NOT f.is_market_holiday AS is_trading_day,
           (SELECT max(o.date_day) FROM open_days o WHERE o.date_day < f.date_day) AS previous_trading_date,
           (SELECT min(o.date_day) FROM open_days o WHERE o.date_day > f.date_day) AS next_trading_date,
           CAST((SELECT count(*) FROM open_days o
                 WHERE o.date_day <= f.date_day AND year(o.date_day) = year(f.date_day)
                   AND month(o.date_day) = month(f.date_day)) AS INTEGER) AS trading_day_of_month,
           CAST((SELECT count(*) FROM open_days o
                 WHERE o.date_day <= f.date_day AND year(o.date_day) = year(f.date_day)) AS INTEGER)
               AS trading_day_of_year
    FROM flags f
)"""

DIM_DATE_COLS = """date_key, date_day, calendar_year, calendar_quarter, calendar_month, calendar_month_name,
    calendar_month_short_name, calendar_week, day_of_month, day_of_week, day_of_week_name, day_of_week_short_name,
    day_of_year, week_start_date, week_end_date, month_start_date, month_end_date, quarter_start_date,
    quarter_end_date, year_start_date, year_end_date, is_weekend, is_weekday, is_market_holiday,
    market_holiday_name, is_trading_day, previous_trading_date, next_trading_date, trading_day_of_month,
    trading_day_of_year"""

B_CAL = (RAW_B, stg_prices("raw_b"), spine_years("trading_date", "stg"), DIM_DATE)

ORACLE_SQL.update({
    "date_spine": with_(RAW_A, spine_years("trade_date", "raw_a")) + "SELECT date_day FROM spine",
    "dim_date": with_(*B_CAL) + f"SELECT {DIM_DATE_COLS} FROM dim_date",
    "dim_date_from_csv": with_(*B_CAL) + f"SELECT {DIM_DATE_COLS} FROM dim_date",
    "trading_day_counters": with_(*B_CAL) +
        "SELECT date_day, is_trading_day, trading_day_of_month, trading_day_of_year FROM dim_date",
    "adjacent_trading_dates": with_(*B_CAL) +
        "SELECT date_day, is_trading_day, previous_trading_date, next_trading_date FROM dim_date",
    "trading_calendar_bars": with_(*B_CAL, WATCHLIST_B) + """
        SELECT s.ticker_symbol, s.trading_date, d.date_key, s.open_price, s.high_price, s.low_price,
               s.close_price, s.volume, d.is_trading_day, d.is_market_holiday, d.market_holiday_name,
               d.day_of_week_short_name
        FROM stg s
        JOIN dim_date d ON s.trading_date = d.date_day
        JOIN (SELECT upper(symbol) AS ticker_symbol FROM watchlist_b) t ON s.ticker_symbol = t.ticker_symbol""",
})


# -- facts, marts, periods -------------------------------------------------------

SIMPLE_DIM_DATE = """
dim_date AS (SELECT CAST(strftime(date_day, '%Y%m%d') AS INTEGER) AS date_key, date_day FROM spine)"""

PRICE_FACT = """
fact_price AS (
    SELECT ticker_symbol, ticker_key, date_key, trading_date, open_price, high_price, low_price,
           close_price, volume, data_source, loaded_at
    FROM stg
    JOIN (SELECT date_day AS trading_date, date_key FROM dim_date) USING (trading_date)
    JOIN (SELECT ticker_symbol, ticker_key FROM dim_ticker) USING (ticker_symbol)
)"""

PERF_FACT = """
fact_perf AS (
    SELECT ticker_symbol, ticker_key, date_key, trading_date, close_price, previous_close_price,
           price_change, daily_return_pct, moving_average_7d, moving_average_20d, moving_average_50d,
           volatility_20d, annualized_volatility_20d
    FROM returns
    JOIN (SELECT ticker_symbol, trading_date, moving_average_7d, moving_average_20d, moving_average_50d
          FROM moving) USING (ticker_symbol, trading_date)
    JOIN (SELECT ticker_symbol, trading_date, volatility_20d, annualized_volatility_20d
          FROM volatility) USING (ticker_symbol, trading_date)
    JOIN (SELECT date_day AS trading_date, date_key FROM dim_date) USING (trading_date)
    JOIN (SELECT ticker_symbol, ticker_key FROM dim_ticker) USING (ticker_symbol)
)"""

A_STAR = (RAW_A, WATCHLIST_A, stg_prices("raw_a"), RETURNS, MOVING, VOLATILITY, STG_TICKERS, DIM_TICKER)
A_SPINE = spine_years("trade_date", "raw_a")
A_FULL = A_STAR + (A_SPINE, SIMPLE_DIM_DATE, PRICE_FACT, PERF_FACT)

MART_ACTIVE = """
mart_active AS (
    SELECT ticker_symbol, company_name, category, currency, country, is_active,
           date_day AS trading_date,
           CAST(year(date_day) AS INTEGER) AS calendar_year, CAST(quarter(date_day) AS INTEGER) AS calendar_quarter,
           CAST(month(date_day) AS INTEGER) AS calendar_month, monthname(date_day) AS calendar_month_name,
           close_price, previous_close_price, daily_return_pct, moving_average_7d, moving_average_20d,
           moving_average_50d, volatility_20d, annualized_volatility_20d, volume
    FROM fact_perf
    JOIN (SELECT ticker_symbol, company_name, category, currency, country, is_active
          FROM dim_ticker WHERE is_active) USING (ticker_symbol)
    JOIN (SELECT date_key, date_day FROM dim_date) USING (date_key)
    JOIN (SELECT ticker_symbol, trading_date, volume FROM fact_price) USING (ticker_symbol, trading_date)
)"""

# Period bounds: one row holding the latest / earliest dates and every start.
ANCHORS = """
bounds AS (
    SELECT max(trading_date) AS latest_date, min(trading_date) AS start_all FROM fact_perf
),
anchors AS (
    SELECT latest_date,
           CAST(latest_date - INTERVAL 29 DAY AS DATE) AS start_30d,
           CAST(latest_date - INTERVAL 89 DAY AS DATE) AS start_90d,
           CAST(date_trunc('year', latest_date) AS DATE) AS start_ytd,
           CAST(date_trunc('month', latest_date) AS DATE) AS start_mtd,
           CAST(latest_date - INTERVAL 1 YEAR AS DATE) AS start_1y,
           start_all
    FROM bounds
),
period_bounds AS (
    SELECT p.period_name, p.period_start, a.latest_date AS period_end
    FROM anchors a,
         LATERAL (VALUES ('ALL_AVAILABLE', a.start_all), ('YTD', a.start_ytd), ('MTD', a.start_mtd),
                         ('30D', a.start_30d), ('90D', a.start_90d), ('1Y', a.start_1y))
             AS p(period_name, period_start)
)"""


def _period_rows(name: str, start_col: str) -> str:
    """Rows of one period: the performance fact restricted to its dates, with
    the volume of the matching price row."""
    return f"""
    SELECT f.ticker_symbol, '{name}' AS period_name, f.trading_date, f.close_price, f.daily_return_pct,
           f.volatility_20d, v.volume
    FROM fact_perf f
    JOIN fact_price v ON v.ticker_symbol = f.ticker_symbol AND v.trading_date = f.trading_date
    WHERE f.trading_date >= (SELECT {start_col} FROM anchors)
      AND f.trading_date <= (SELECT latest_date FROM anchors)"""


SUMMARY = """
in_period AS (""" + "\n    UNION ALL".join(_period_rows(n, c) for n, c in [
    ("ALL_AVAILABLE", "start_all"), ("YTD", "start_ytd"), ("MTD", "start_mtd"),
    ("30D", "start_30d"), ("90D", "start_90d"), ("1Y", "start_1y")]) + """
),
per_period AS (
    SELECT ticker_symbol, period_name,
           min(trading_date) AS first_day, max(trading_date) AS last_day, count(*) AS days,
           min(close_price) AS low_close, max(close_price) AS high_close,
           avg(daily_return_pct) AS mean_return, avg(volatility_20d) AS mean_vol, avg(volume) AS mean_volume
    FROM in_period GROUP BY ticker_symbol, period_name
),
with_ends AS (
    SELECT g.*,
           (SELECT f.close_price FROM fact_perf f
             WHERE f.ticker_symbol = g.ticker_symbol AND f.trading_date = g.first_day) AS first_close,
           (SELECT f.close_price FROM fact_perf f
             WHERE f.ticker_symbol = g.ticker_symbol AND f.trading_date = g.last_day) AS last_close
    FROM per_period g
),
summary AS (
    SELECT e.ticker_symbol, t.company_name, t.category, e.period_name,
           e.first_day AS period_start_date, e.last_day AS period_end_date,
           e.first_close AS start_close_price, e.last_close AS end_close_price,
           CASE WHEN e.first_close IS NULL OR e.first_close = 0 THEN NULL
                ELSE CAST(e.last_close - e.first_close AS DOUBLE) / CAST(e.first_close AS DOUBLE)
           END AS period_return_pct,
           round(e.mean_return, 6) AS avg_daily_return_pct, round(e.mean_vol, 6) AS volatility_pct,
           e.low_close AS min_close_price, e.high_close AS max_close_price,
           round(e.mean_volume, 6) AS avg_volume, e.days AS trading_days_count
    FROM with_ends e
    JOIN dim_ticker t ON t.ticker_symbol = e.ticker_symbol
)"""

ORACLE_SQL.update({
    "fact_price_daily": with_(*A_FULL) + "SELECT * FROM fact_price",
    "fact_performance_daily": with_(*A_FULL) +
        "SELECT * REPLACE (round(volatility_20d, 6) AS volatility_20d, "
        "round(annualized_volatility_20d, 6) AS annualized_volatility_20d) FROM fact_perf",
    "mart_active_performance": with_(*A_FULL, MART_ACTIVE) +
        "SELECT * REPLACE (round(volatility_20d, 6) AS volatility_20d, "
        "round(annualized_volatility_20d, 6) AS annualized_volatility_20d) FROM mart_active",
    "period_anchors": with_(*A_FULL, ANCHORS) + "SELECT * FROM anchors",
    "period_definitions": with_(*A_FULL, ANCHORS) + "SELECT * FROM period_bounds",
    "period_summary": with_(*A_FULL, ANCHORS, SUMMARY) + "SELECT * FROM summary",
})


# -- page analytics -----------------------------------------------------------------
LATEST_ACTIVE = "(SELECT max(trading_date) FROM mart_active)"
HISTORY_START = {
    "30D": f"CAST({LATEST_ACTIVE} - INTERVAL 29 DAY AS DATE)", "90D": f"CAST({LATEST_ACTIVE} - INTERVAL 89 DAY AS DATE)",
    "YTD": f"CAST(date_trunc('year', {LATEST_ACTIVE}) AS DATE)", "1Y": f"CAST({LATEST_ACTIVE} - INTERVAL 1 YEAR AS DATE)",
}


def history(period: str, symbol: str | None = None) -> str:
    one = f" AND ticker_symbol = '{symbol}'" if symbol else ""
    return f"""
hist AS (
    SELECT ticker_symbol, trading_date,
           TRY_CAST(close_price AS DOUBLE) AS close_price,
           TRY_CAST(moving_average_7d AS DOUBLE) AS moving_average_7d,
           TRY_CAST(moving_average_20d AS DOUBLE) AS moving_average_20d,
           TRY_CAST(moving_average_50d AS DOUBLE) AS moving_average_50d,
           TRY_CAST(daily_return_pct AS DOUBLE) AS daily_return_pct,
           TRY_CAST(volume AS DOUBLE) AS volume,
           TRY_CAST(volatility_20d AS DOUBLE) AS volatility_20d,
           TRY_CAST(annualized_volatility_20d AS DOUBLE) AS annualized_volatility_20d
    FROM mart_active
    WHERE trading_date >= {HISTORY_START.get(period, "DATE '1900-01-01'")}{one}
)"""


HISTORY_90D = history("90D") + """,
snap AS (
    SELECT ticker_symbol, max(trading_date) AS trading_date,
           arg_max(close_price, trading_date) AS close_price,
           arg_max(daily_return_pct, trading_date) AS daily_return_pct,
           arg_max(moving_average_20d, trading_date) AS moving_average_20d,
           arg_max(annualized_volatility_20d, trading_date) AS annualized_volatility_20d
    FROM hist GROUP BY ticker_symbol
),
ends AS (
    SELECT ticker_symbol, arg_min(close_price, trading_date) AS first_close,
           arg_max(close_price, trading_date) AS last_close,
           avg(volume) AS avg_daily_volume, count(*) AS trading_days
    FROM hist GROUP BY ticker_symbol
),
cum AS (
    SELECT h.ticker_symbol, h.trading_date,
           (CASE WHEN b.base = 0 OR b.base IS NULL THEN NULL ELSE h.close_price / b.base END - 1) * 100
               AS cumulative_return_pct
    FROM hist h JOIN (SELECT ticker_symbol, arg_min(close_price, trading_date) AS base
                      FROM hist GROUP BY ticker_symbol) b ON h.ticker_symbol = b.ticker_symbol
)"""

A_HIST = A_FULL + (MART_ACTIVE, HISTORY_90D)

ORACLE_SQL.update({
    "ticker_history_90d": with_(*A_HIST) +
        "SELECT * REPLACE (round(volatility_20d, 6) AS volatility_20d, "
        "round(annualized_volatility_20d, 6) AS annualized_volatility_20d) FROM hist",
    **{name: with_(*A_FULL, MART_ACTIVE, history(period, symbol)) +
       "SELECT * REPLACE (round(volatility_20d, 6) AS volatility_20d, "
       "round(annualized_volatility_20d, 6) AS annualized_volatility_20d) FROM hist"
       for name, period, symbol in [("ticker_history_30d", "30D", None), ("ticker_history_ytd", "YTD", None),
                                    ("ticker_history_1y", "1Y", None), ("ticker_history_all", "ALL_AVAILABLE", None),
                                    ("ticker_history_unknown", "5Y", None), ("ticker_history_symbol", "1Y", "S1")]},
    "summary_ordered": with_(*A_FULL, ANCHORS, SUMMARY) + """
        SELECT ticker_symbol,
               CASE period_name WHEN 'MTD' THEN 1 WHEN '30D' THEN 2 WHEN '90D' THEN 3 WHEN 'YTD' THEN 4
                                WHEN '1Y' THEN 5 WHEN 'ALL_AVAILABLE' THEN 6 END AS period_rank,
               period_name, period_start_date, period_end_date,
               TRY_CAST(start_close_price AS DOUBLE) AS start_close_price,
               TRY_CAST(end_close_price AS DOUBLE) AS end_close_price,
               TRY_CAST(period_return_pct AS DOUBLE) AS period_return_pct,
               TRY_CAST(avg_daily_return_pct AS DOUBLE) AS avg_daily_return_pct,
               TRY_CAST(volatility_pct AS DOUBLE) AS volatility_pct,
               TRY_CAST(min_close_price AS DOUBLE) AS min_close_price,
               TRY_CAST(max_close_price AS DOUBLE) AS max_close_price,
               TRY_CAST(avg_volume AS DOUBLE) AS avg_volume,
               TRY_CAST(trading_days_count AS DOUBLE) AS trading_days_count
        FROM summary""",
    "latest_snapshot": with_(*A_HIST) +
        "SELECT * REPLACE (round(annualized_volatility_20d, 6) AS annualized_volatility_20d) FROM snap",
    "signals": with_(*A_HIST) + """
        SELECT ticker_symbol, trading_date,
               CASE WHEN close_price IS NULL OR moving_average_20d IS NULL OR close_price = 0
                         OR moving_average_20d = 0 THEN NULL
                    WHEN close_price > moving_average_20d THEN 'bullish' ELSE 'bearish' END AS ma20_signal,
               coalesce(annualized_volatility_20d > 0.30, FALSE) AS high_volatility,
               coalesce(abs(daily_return_pct) > 0.03, FALSE) AS unusual_move
        FROM snap""",
    "benchmark_cumulative_return": with_(*A_HIST) + """
        , choice AS (
            SELECT t.ticker_symbol,
                   (SELECT min(o.ticker_symbol) FROM (SELECT DISTINCT ticker_symbol FROM hist) o
                    WHERE o.ticker_symbol <> t.ticker_symbol) AS benchmark_symbol
            FROM (SELECT DISTINCT ticker_symbol FROM hist) t)
        SELECT c.ticker_symbol, ch.benchmark_symbol, c.trading_date,
               c.cumulative_return_pct AS ticker_cumulative_return_pct,
               b.cumulative_return_pct AS benchmark_cumulative_return_pct
        FROM cum c
        JOIN choice ch ON c.ticker_symbol = ch.ticker_symbol
        JOIN cum b ON b.ticker_symbol = ch.benchmark_symbol AND b.trading_date = c.trading_date""",
    "investment_scenario": with_(*A_HIST) + """
        SELECT ticker_symbol, first_close, last_close,
               CASE WHEN first_close = 0 OR first_close IS NULL THEN NULL
                    ELSE (last_close - first_close) / first_close END * 100 AS period_return_pct,
               CASE WHEN first_close = 0 OR first_close IS NULL THEN NULL ELSE 10000.0 / first_close END AS shares,
               CASE WHEN first_close = 0 OR first_close IS NULL THEN NULL ELSE 10000.0 / first_close END
                   * last_close AS end_value,
               CASE WHEN first_close = 0 OR first_close IS NULL THEN NULL ELSE 10000.0 / first_close END
                   * last_close - 10000.0 AS gain_loss,
               round(avg_daily_volume, 6) AS avg_daily_volume, trading_days
        FROM ends""",
    "chart_series": with_(*A_HIST) + """
        SELECT ticker_symbol, trading_date, close_price AS "Close", moving_average_7d AS "MA 7d",
               moving_average_20d AS "MA 20d", moving_average_50d AS "MA 50d"
        FROM hist""",
    "watchlist_listing_active": with_(WATCHLIST_A) +
        "SELECT symbol, company_name, category, notes, is_active, created_at, updated_at FROM watchlist_a "
        "WHERE is_active ORDER BY symbol",
    "watchlist_listing": with_(WATCHLIST_A) +
        "SELECT symbol, company_name, category, notes, is_active, created_at, updated_at FROM watchlist_a "
        "ORDER BY is_active DESC, symbol ASC",
    "active_symbols": with_(WATCHLIST_A) + "SELECT symbol FROM watchlist_a WHERE is_active ORDER BY symbol",
})


ORACLE_SQL["summary_of_symbol"] = ORACLE_SQL["summary_ordered"] + " WHERE ticker_symbol = 'S1'"


def _shown(form: str, value: str) -> str:
    return f"format('{form}', CAST({value} AS DOUBLE))"


ORACLE_SQL["summary_display"] = with_(*A_FULL, ANCHORS, SUMMARY) + f"""
SELECT ticker_symbol,
       CASE period_name WHEN 'MTD' THEN 1 WHEN '30D' THEN 2 WHEN '90D' THEN 3 WHEN 'YTD' THEN 4
                        WHEN '1Y' THEN 5 WHEN 'ALL_AVAILABLE' THEN 6 END AS period_rank,
       period_name AS "Period", first_day AS "Start", last_day AS "End",
       coalesce({_shown('${:,.2f}', 'first_close')}, '$nan') AS "Start Price",
       coalesce({_shown('${:,.2f}', 'last_close')}, '$nan') AS "End Price",
       coalesce({_shown('{:+.2f}%', "CAST(last_close - first_close AS DOUBLE) / CAST(nullif(first_close, 0) AS DOUBLE) * 100")},
                '+nan%') AS "Total Return",
       coalesce({_shown('{:+.4f}%', 'mean_return * 100')}, '+nan%') AS "Avg Daily Return",
       coalesce({_shown('{:.2f}%', 'mean_vol * 100')}, 'nan%') AS "Volatility",
       CAST(low_close AS DOUBLE) AS "Min Price", CAST(high_close AS DOUBLE) AS "Max Price",
       coalesce({_shown('{:,.0f}', 'mean_volume')}, 'nan') AS "Avg Volume", days AS "Trading Days"
FROM with_ends JOIN dim_ticker USING (ticker_symbol)"""


# -- watchlist changes ----------------------------------------------------------------
CHANGES_C = """
changes_c AS (
    SELECT event_id, ts AS event_ts,
           CASE WHEN event_type = 'purchase' THEN ' ' || chr(9) || 'u' || CAST(user_id AS VARCHAR) || ' '
                ELSE 'U' || CAST(user_id AS VARCHAR) END AS symbol,
           CASE event_type WHEN 'signup' THEN 'add' WHEN 'purchase' THEN 'add' WHEN 'error' THEN 'deactivate'
                           WHEN 'view' THEN 'reactivate' WHEN 'click' THEN 'update' END AS op,
           CASE WHEN event_type = 'purchase' THEN '' END AS company_name, event_type AS category,
           CAST(value AS VARCHAR) AS notes
    FROM events
)"""

DIRTY_C = """
dirty_c AS (
    SELECT event_id, CASE WHEN event_id % 11 <> 3 THEN event_ts END AS event_ts,
           CASE event_id % 11 WHEN 0 THEN NULL WHEN 1 THEN '  ' WHEN 2 THEN '' ELSE symbol END AS symbol,
           op, company_name, category, notes
    FROM changes_c
)"""

HOT_C = """
hot_c AS (
    SELECT event_id, event_ts - (CAST(event_ts AS DATE) - DATE '2024-01-01') * INTERVAL 1 DAY AS event_ts,
           CASE WHEN event_id % 3 < 2 THEN 'HOT' ELSE symbol END AS symbol, op, company_name, category, notes
    FROM changes_c
)"""


def fold(name: str, changes: str, snapshot: str | None = None) -> str:
    """A change log folded over an optional snapshot relation, one change after
    the other: step ``n`` of the recursion applies every symbol's n-th event to
    the symbol's state."""
    seed = "" if snapshot is None else f"""
        UNION ALL
        SELECT symbol, 0 AS phase, updated_at AS event_ts, -1 AS event_id, 'seed' AS op, company_name, category,
               notes, is_active AS seed_active, created_at AS seed_created, watchlist_id AS seed_id
        FROM {snapshot}"""
    top = "0" if snapshot is None else f"(SELECT coalesce(max(watchlist_id), 0) FROM {snapshot})"
    return f"""
{name}_all AS (
    SELECT CASE WHEN op = 'add' THEN regexp_replace(upper(symbol), '^\\s+|\\s+$', '', 'g') ELSE symbol END AS symbol,
           1 AS phase, event_ts, event_id, op, nullif(company_name, '') AS company_name,
           nullif(category, '') AS category, nullif(notes, '') AS notes,
           CAST(NULL AS BOOLEAN) AS seed_active, CAST(NULL AS TIMESTAMP) AS seed_created, CAST(NULL AS BIGINT) AS seed_id
    FROM {changes}{seed}
),
{name}_ev AS (
    SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY phase, event_ts NULLS FIRST, event_id) AS n
    FROM {name}_all WHERE symbol <> ''
),
{name}_walk AS (
    SELECT symbol, CAST(0 AS BIGINT) AS n, FALSE AS there, FALSE AS active, CAST(NULL AS VARCHAR) AS company_name,
           CAST(NULL AS VARCHAR) AS category, CAST(NULL AS VARCHAR) AS notes, CAST(NULL AS TIMESTAMP) AS created_at,
           CAST(NULL AS TIMESTAMP) AS updated_at, CAST(NULL AS BIGINT) AS id, FALSE AS was_there, FALSE AS was_active,
           FALSE AS changed
    FROM (SELECT DISTINCT symbol FROM {name}_ev)
    UNION ALL
    SELECT w.symbol, e.n, w.there OR e.op IN ('seed', 'add'),
           CASE WHEN e.op = 'seed' THEN e.seed_active WHEN e.op = 'add' THEN TRUE
                WHEN w.there AND e.op = 'reactivate' THEN TRUE WHEN w.there AND e.op = 'deactivate' THEN FALSE
                ELSE w.active END,
           CASE WHEN c.attrs THEN e.company_name ELSE w.company_name END,
           CASE WHEN c.attrs THEN e.category ELSE w.category END,
           CASE WHEN c.attrs THEN e.notes ELSE w.notes END,
           CASE WHEN e.op = 'seed' THEN e.seed_created WHEN e.op = 'add' AND NOT w.there THEN e.event_ts ELSE w.created_at END,
           CASE WHEN c.does THEN e.event_ts ELSE w.updated_at END, coalesce(e.seed_id, w.id), w.there, w.active, c.does
    FROM {name}_walk w JOIN {name}_ev e ON e.symbol = w.symbol AND e.n = w.n + 1,
         LATERAL (SELECT e.op = 'seed' OR (e.op = 'add' AND NOT (w.there AND w.active)) OR (e.op = 'update' AND w.there) AS attrs,
                         e.op = 'seed' OR (e.op = 'add' AND NOT (w.there AND w.active)) OR (e.op = 'update' AND w.there)
                         OR (e.op = 'deactivate' AND w.there AND w.active)
                         OR (e.op = 'reactivate' AND w.there AND NOT w.active) AS does) c
),
{name} AS (
    SELECT coalesce(id, {top} + row_number() OVER (PARTITION BY id IS NULL ORDER BY symbol)) AS watchlist_id,
           symbol, company_name, category, notes, active AS is_active, created_at, updated_at
    FROM {name}_walk w WHERE there AND n = (SELECT max(e.n) FROM {name}_ev e WHERE e.symbol = w.symbol)
)"""


def outcomes(name: str) -> str:
    return f"""
SELECT e.event_id, e.event_ts, e.symbol, e.op,
       CASE WHEN e.op = 'add' AND NOT was_there THEN 'added'
            WHEN e.op = 'add' AND NOT was_active THEN 'reactivated'
            WHEN e.op = 'add' THEN 'already_active'
            WHEN NOT was_there THEN 'not_found'
            WHEN e.op = 'deactivate' AND was_active THEN 'deactivated'
            WHEN e.op = 'deactivate' THEN 'already_inactive'
            WHEN e.op = 'reactivate' AND NOT was_active THEN 'reactivated'
            WHEN e.op = 'reactivate' THEN 'already_active'
            WHEN e.op = 'update' THEN 'updated' ELSE 'not_found' END AS outcome, w.changed
FROM {name}_ev e JOIN {name}_walk w ON w.symbol = e.symbol AND w.n = e.n WHERE e.op <> 'seed'
UNION ALL
SELECT event_id, event_ts, symbol, op, 'invalid_symbol', FALSE FROM {name}_all
WHERE op <> 'seed' AND coalesce(symbol, '') = ''"""


def folded(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",".join(ctes) + "\n"


def _starter_values() -> str:
    from tickspan.sources.starter import STARTER_TICKERS
    return ", ".join("(" + ", ".join("'" + v.replace("'", "''") + "'" for v in row) + ")" for row in STARTER_TICKERS)


FOLD_C = (CHANGES_C, fold("wl", "changes_c"))

ORACLE_SQL.update({
    "watchlist_apply_changes": folded(*FOLD_C) + "SELECT * FROM wl",
    "watchlist_change_outcomes": folded(*FOLD_C) + outcomes("wl"),
    "watchlist_outcomes_dirty": folded(CHANGES_C, DIRTY_C, fold("dirty", "dirty_c")) + outcomes("dirty"),
    "watchlist_outcomes_hot_symbol": folded(CHANGES_C, HOT_C, fold("hot", "hot_c")) + outcomes("hot"),
    "watchlist_hot_symbol_applied": folded(CHANGES_C, HOT_C, fold("hot", "hot_c")) + "SELECT * FROM hot",
    "starter_rows_inserted": with_(WATCHLIST_A) + f"""
        SELECT (SELECT max(watchlist_id) FROM watchlist_a) + row_number() OVER (ORDER BY s.symbol) AS watchlist_id, s.*,
               TRUE AS is_active, TIMESTAMP '2024-02-01 00:00:00' AS created_at, TIMESTAMP '2024-02-01 00:00:00' AS updated_at
        FROM (VALUES {_starter_values()}) AS s(symbol, company_name, category, notes)
        WHERE s.symbol NOT IN (SELECT symbol FROM watchlist_a)""",
    "raw_rows_with_defaults": with_(RAW_A) + """
        SELECT * REPLACE (CASE WHEN volume % 2 = 0 THEN loaded_at ELSE TIMESTAMP '2024-02-01 00:00:00' END AS loaded_at)
        FROM raw_a""",
    "watchlist_fold_from_snapshot": folded(
        CHANGES_C, "adds AS (SELECT * FROM changes_c WHERE op = 'add')",
        "rest AS (SELECT * FROM changes_c WHERE op <> 'add')",
        fold("snap1", "adds"), fold("snap2", "rest", "snap1")) + "SELECT * FROM snap2",
    "insert_if_absent": folded(*FOLD_C, RAW_B, WATCHLIST_A, STG_TICKERS) + """
        , cand AS (SELECT DISTINCT symbol, CAST(NULL AS VARCHAR) AS company_name, 'auto' AS category,
                          CAST(NULL AS VARCHAR) AS notes FROM raw_b
                   UNION ALL
                   SELECT ticker_symbol, company_name, category, notes FROM stg_tickers)
        SELECT (SELECT coalesce(max(watchlist_id), 0) FROM wl) + row_number() OVER (ORDER BY c.symbol) AS watchlist_id,
               c.symbol, c.company_name, c.category, c.notes,
               TRUE AS is_active, TIMESTAMP '2024-02-01 00:00:00' AS created_at,
               TIMESTAMP '2024-02-01 00:00:00' AS updated_at
        FROM cand c WHERE NOT EXISTS (SELECT 1 FROM wl w WHERE w.symbol = c.symbol)""",
})


# -- data quality (generated from the same declared-test table) ---------------------
from tickspan.operators.quality import DECLARED_TESTS, GRAIN_TESTS  # noqa: E402

DQ_RELATION = {
    "stg_market__stock_prices": "stg", "stg_market__tickers": "stg_tickers",
    "int_stock_daily_returns": "returns", "int_stock_moving_averages": "moving",
    "int_stock_volatility": "volatility", "dim_ticker": "dim_ticker", "dim_date": "dim_date",
    "fact_stock_price_daily": "fact_price", "fact_stock_performance_daily": "fact_perf",
    "mart_watchlist_performance": "mart_active", "mart_ticker_performance_summary": "summary",
}
A_DQ = A_STAR + (A_SPINE, DIM_DATE, PRICE_FACT, PERF_FACT,
                 MART_ACTIVE, ANCHORS, SUMMARY)


def _lit_list(values) -> str:
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)


def _dq_sql(kind: str, relation: dict = DQ_RELATION) -> str:
    parts = []
    for m, c, t, a in DECLARED_TESTS:
        if t != kind or m not in relation:
            continue
        r = relation[m]
        head = f"SELECT '{m}' AS model, '{c}' AS column_name, '{t}' AS test, "
        if t == "not_null":
            parts.append(head + f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS failures FROM {r}")
        elif t == "unique":
            parts.append(head + f"CAST(count(*) AS BIGINT) AS failures FROM "
                         f"(SELECT {c} FROM {r} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1) x")
        elif t == "accepted_values":
            parts.append(head + f"CAST(count(*) AS BIGINT) AS failures FROM "
                         f"(SELECT {c} AS v FROM {r} GROUP BY {c}) x WHERE v NOT IN ({_lit_list(a)})")
        elif t == "relationships":
            pr, pf = relation[a[0]], a[1]
            parts.append(head + f"CAST(count(*) AS BIGINT) AS failures FROM {r} ch WHERE ch.{c} IS NOT NULL "
                         f"AND NOT EXISTS (SELECT 1 FROM {pr} p WHERE p.{pf} = ch.{c})")
    return "\nUNION ALL\n".join(parts)


def _grain_sql(relation: dict = DQ_RELATION) -> str:
    parts = []
    for m, cols in GRAIN_TESTS:
        if m not in relation:
            continue
        r, k = relation[m], ", ".join(cols)
        nn = " AND ".join(f"{c} IS NOT NULL" for c in cols)
        parts.append(f"SELECT '{m}' AS model, '{','.join(cols)}' AS column_name, 'unique_grain' AS test, "
                     f"CAST(count(*) AS BIGINT) AS failures FROM (SELECT {k} FROM {r} WHERE {nn} "
                     f"GROUP BY {k} HAVING count(*) > 1) x")
    return "\nUNION ALL\n".join(parts)


ORACLE_SQL.update({
    "dq_not_null": with_(*A_DQ) + _dq_sql("not_null"),
    "dq_unique": with_(*A_DQ) + _dq_sql("unique"),
    "dq_accepted": with_(*A_DQ) + _dq_sql("accepted_values"),
    "dq_relationships": with_(*A_DQ) + _dq_sql("relationships"),
    "dq_grain": with_(*A_DQ) + _grain_sql(),
})


VIOLATING = """
v_stg AS (
    SELECT symbol AS ticker_symbol, trade_date AS trading_date,
           CASE WHEN volume % 7 <> 0 THEN CAST(open AS DECIMAL(18,4)) END AS open_price,
           CAST(high AS DECIMAL(18,4)) AS high_price, CAST(low AS DECIMAL(18,4)) AS low_price,
           CAST(close AS DECIMAL(18,4)) AS close_price, volume,
           CASE WHEN volume % 5 = 0 THEN 'manual' ELSE source END AS data_source, loaded_at
    FROM raw_a
),
v_tickers AS (
    SELECT * FROM stg_tickers UNION ALL
    SELECT * REPLACE (CAST(NULL AS BIGINT) AS ticker_id) FROM stg_tickers WHERE ticker_id % 2 = 0
),
v_dim_ticker AS (SELECT * FROM dim_ticker WHERE is_active),
v_dim_date AS (SELECT * FROM dim_date WHERE calendar_quarter <> 1),
v_fact AS (
    SELECT *, CASE WHEN volume % 3 <> 0 THEN volume END AS ticker_key,
           CAST(strftime(trading_date, '%Y%m%d') AS INTEGER) AS date_key
    FROM v_stg
)"""
V_RELATION = {"stg_market__stock_prices": "v_stg", "stg_market__tickers": "v_tickers", "dim_ticker": "v_dim_ticker",
              "dim_date": "v_dim_date", "fact_stock_price_daily": "v_fact"}
ORACLE_SQL["dq_violations"] = with_(RAW_A, WATCHLIST_A, STG_TICKERS, DIM_TICKER, A_SPINE, DIM_DATE, VIOLATING) + (
    "\nUNION ALL\n".join([_dq_sql(k, V_RELATION) for k in ("not_null", "unique", "accepted_values", "relationships")]
                         + [_grain_sql(V_RELATION)]))


# -- landed documents: flattening must give back the raw rows -------------------------
ORACLE_SQL.update({
    "json_series_flatten": with_(RAW_A) +
        "SELECT symbol, trade_date, open, high, low, close, volume, source FROM raw_a",
    "landed_files_flatten": with_(RAW_A) +
        "SELECT symbol, trade_date, open, high, low, close, volume, source FROM raw_a",
    "json_series_rejects": with_(WATCHLIST_A) + """
        SELECT upper(symbol) AS symbol,
               CASE watchlist_id % 4 WHEN 0 THEN 'Thank you for using the API. Request limit reached.'
                                     WHEN 1 THEN 'This is a premium endpoint.'
                                     WHEN 2 THEN '{"Error Message":"no symbol ' || symbol || '"}'
                                     ELSE '{"Note": "cut short ' || symbol END AS message
        FROM watchlist_a WHERE NOT is_active""",
    "landed_files_rejects": with_(WATCHLIST_A) + """
        SELECT CASE WHEN watchlist_id % 4 <> 3 THEN upper(symbol) END AS symbol,
               CASE watchlist_id % 4 WHEN 0 THEN 'Thank you for using the API. Request limit reached.'
                                     WHEN 1 THEN 'This is a premium endpoint.'
                                     WHEN 2 THEN '{"Error Message":"no symbol ' || symbol || '"}'
                                     ELSE '{"symbol":"' || upper(symbol) || '","fetched_at":"2002-01-01T00:00:00.000","body":'
                                          || '{"Note": "cut short ' || symbol || '}' END AS message
        FROM watchlist_a WHERE NOT is_active""",
})


ORACLE_SQL["indicators_year_buckets"] = with_(*A_BASE, RETURNS, MOVING, VOLATILITY) + """
SELECT s.ticker_symbol, s.trading_date, s.open_price, s.high_price, s.low_price, s.close_price, s.volume,
       s.data_source, s.loaded_at, r.previous_close_price, r.price_change, r.daily_return_pct,
       m.moving_average_7d, m.moving_average_20d, m.moving_average_50d,
       round(v.volatility_20d, 6) AS volatility_20d, round(v.annualized_volatility_20d, 6) AS annualized_volatility_20d
FROM stg s
JOIN returns r ON s.ticker_symbol = r.ticker_symbol AND s.trading_date = r.trading_date
JOIN moving m ON s.ticker_symbol = m.ticker_symbol AND s.trading_date = m.trading_date
JOIN volatility v ON s.ticker_symbol = v.ticker_symbol AND s.trading_date = v.trading_date"""

ORACLE_SQL.update({
    "landed_append_repeated": with_(RAW_A) + "SELECT * FROM raw_a",
    "rebuilt_price_facts": ORACLE_SQL["fact_price_daily"],
    "rebuilt_staging_view": ORACLE_SQL["stage_tickers"],
})

ORACLE_SQL.update({
    "dedup_base_and_landed": ORACLE_SQL["dedup_latest_prices"],
    "indicators_incremental": ORACLE_SQL["indicators_year_buckets"],
    "indicators_appended": ORACLE_SQL["indicators_year_buckets"],
})

"""Explicit schemas of every dataset (never inferred)."""

from pyspark.sql.types import (
    BooleanType, DateType, DecimalType, DoubleType, IntegerType, LongType, MapType,
    StringType, StructField, StructType, TimestampNTZType,
)

PRICE = DecimalType(18, 4)

RAW_STOCK_PRICES = StructType([
    StructField("symbol", StringType(), False),
    StructField("trade_date", DateType(), False),
    StructField("open", DoubleType(), True),
    StructField("high", DoubleType(), True),
    StructField("low", DoubleType(), True),
    StructField("close", DoubleType(), True),
    StructField("volume", LongType(), True),
    StructField("source", StringType(), False),
    StructField("loaded_at", TimestampNTZType(), False),
])

WATCHLIST = StructType([
    StructField("watchlist_id", LongType(), True),
    StructField("symbol", StringType(), False),
    StructField("company_name", StringType(), True),
    StructField("category", StringType(), True),
    StructField("notes", StringType(), True),
    StructField("is_active", BooleanType(), False),
    StructField("created_at", TimestampNTZType(), False),
    StructField("updated_at", TimestampNTZType(), False),
])

MARKET_HOLIDAYS = StructType([
    StructField("holiday_date", DateType(), False),
    StructField("market_code", StringType(), False),
    StructField("holiday_name", StringType(), True),
    StructField("is_full_day_closure", BooleanType(), True),
    StructField("is_early_close", BooleanType(), True),
])

# Change log driving the watchlist fold (carries what the add / deactivate /
# reactivate / update calls take as arguments).
WATCHLIST_CHANGES = StructType([
    StructField("event_id", LongType(), False),
    StructField("event_ts", TimestampNTZType(), False),
    StructField("symbol", StringType(), False),
    StructField("op", StringType(), False),
    StructField("company_name", StringType(), True),
    StructField("category", StringType(), True),
    StructField("notes", StringType(), True),
])

# One landed API document per row: the symbol comes from the request, the body
# is the JSON text returned by the daily-series endpoint.
_BAR_FIELDS = ["1. open", "2. high", "3. low", "4. close", "5. volume"]
API_BAR = StructType([StructField(f, StringType(), True) for f in _BAR_FIELDS])
API_BODY = StructType([
    StructField("Time Series (Daily)", MapType(StringType(), API_BAR), True),
    StructField("Note", StringType(), True),
    StructField("Information", StringType(), True),
])

STG_STOCK_PRICES_COLUMNS = [
    "ticker_symbol", "trading_date", "open_price", "high_price", "low_price",
    "close_price", "volume", "data_source", "loaded_at",
]

DIM_DATE_COLUMNS = [
    "date_key", "date_day", "calendar_year", "calendar_quarter", "calendar_month",
    "calendar_month_name", "calendar_month_short_name", "calendar_week", "day_of_month",
    "day_of_week", "day_of_week_name", "day_of_week_short_name", "day_of_year",
    "week_start_date", "week_end_date", "month_start_date", "month_end_date",
    "quarter_start_date", "quarter_end_date", "year_start_date", "year_end_date",
    "is_weekend", "is_weekday", "is_market_holiday", "market_holiday_name",
    "is_trading_day", "previous_trading_date", "next_trading_date",
    "trading_day_of_month", "trading_day_of_year",
]

__all__ = [n for n in dir() if n.isupper()] + [
    "BooleanType", "DateType", "DecimalType", "DoubleType", "IntegerType", "LongType",
    "StringType", "StructField", "StructType", "TimestampNTZType",
]

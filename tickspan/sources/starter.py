"""Starter watchlist rows (S8) inserted when the watchlist is created."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

# ---------------------------------------------------------------------------
# The six starter tickers (symbol, company, category, notes).
# The ASTS note keeps its leading blank: notes are stored untrimmed.
# ---------------------------------------------------------------------------
STARTER_TICKERS = [
    ("AAPL", "Apple Inc.", "Tech", "Core holding"),
    ("MSFT", "Microsoft Corporation", "Tech", "Cloud & AI exposure"),
    ("GOOGL", "Alphabet Inc.", "Tech", "Advertising + AI"),
    ("JPM", "JPMorgan Chase & Co.", "Finance", "Large-cap bank"),
    ("SPY", "SPDR S&P 500 ETF", "ETF", "Benchmark index"),
    ("ASTS", "AST SpaceMobile, Inc.", "Space", " Communication Equipment / Wireless Telecommunications"),
]

STARTER_SCHEMA = StructType([
    StructField("symbol", StringType(), False),
    StructField("company_name", StringType(), True),
    StructField("category", StringType(), True),
    StructField("notes", StringType(), True),
])


def starter_tickers(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(STARTER_TICKERS, STARTER_SCHEMA)

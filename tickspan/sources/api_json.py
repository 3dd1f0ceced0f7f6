"""Landed daily-series API documents → raw price rows (S1) and rejects (S2).

A landed document carries the symbol it was requested for (the body does not
name it), the fetch time, and the response body::

    {"symbol": "AAPL", "fetched_at": "2024-01-03T06:00:00",
     "body": {"Time Series (Daily)": {"2024-01-02": {"1. open": "187.15", ...}}}}

Documents are read as lines of text; the body's own text is kept next to the
parsed one, so a reject can name the whole document. All values arrive as
strings and are cast here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampNTZType

from tickspan.schemas import API_BODY

SERIES = "Time Series (Daily)"
SOURCE = "alpha_vantage"

LANDED_JSON = StructType([
    StructField("symbol", StringType(), False),
    StructField("fetched_at", TimestampNTZType(), True),
    StructField("body", StringType(), True),
])


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """Landed documents (JSON Lines): symbol, fetched_at, the body's text as
    ``raw_body`` and the parsed ``body``."""
    return parse_lines(spark.read.text(path))


def parse_lines(lines: DataFrame) -> DataFrame:
    """Lines of text in ``value`` → documents. A nested body is taken as its own
    JSON text; a line that is no document, or has no body, stands for its body."""
    doc = lines.where(F.trim("value") != "").select("value", F.from_json("value", LANDED_JSON).alias("d"))
    raw = doc.select(F.col("d.symbol").alias("symbol"), F.col("d.fetched_at").alias("fetched_at"),
                     F.coalesce("d.body", "value").alias("raw_body"))
    return raw.withColumn("body", F.from_json("raw_body", API_BODY))


def parse_bodies(docs: DataFrame, body_col: str = "body") -> DataFrame:
    """Documents whose body is JSON text → the same with a parsed ``body``
    struct; the text is kept as ``raw_body`` for reject messages."""
    return docs.withColumns({"raw_body": F.col(body_col),
                             "body": F.from_json(F.col(body_col), API_BODY)})


def _series(body: Column) -> Column:
    return body.getField(SERIES)


def flatten_series(docs: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """One raw price row per (document, date) in the ``RAW_STOCK_PRICES``
    layout. ``loaded_at`` defaults to the document's fetch time. Documents
    without a series yield no rows (see ``rejects``)."""
    ok = docs.where(_series(F.col("body")).isNotNull() & F.col("symbol").isNotNull())
    rows = ok.select("symbol", "fetched_at",
                     F.explode(_series(F.col("body"))).alias("day", "bar"))
    bar = F.col("bar")
    return rows.select(
        F.col("symbol"),
        F.col("day").cast("date").alias("trade_date"),
        bar.getField("1. open").cast("double").alias("open"),
        bar.getField("2. high").cast("double").alias("high"),
        bar.getField("3. low").cast("double").alias("low"),
        bar.getField("4. close").cast("double").alias("close"),
        bar.getField("5. volume").cast("bigint").alias("volume"),
        F.lit(SOURCE).alias("source"),
        (loaded_at if loaded_at is not None else F.col("fetched_at")).alias("loaded_at"),
    )


def rejects(docs: DataFrame) -> DataFrame:
    """Documents without a series (or without a symbol, or unparseable):
    symbol, fetch time and the message – the ``Note`` if non-empty, else
    ``Information``, else the whole document."""
    bad = docs.where(_series(F.col("body")).isNull() | F.col("symbol").isNull())
    msg = F.coalesce(F.nullif(F.col("body.Note"), F.lit("")),
                     F.nullif(F.col("body.Information"), F.lit("")), F.col("raw_body"))
    return bad.select("symbol", "fetched_at", msg.alias("message"))


def series_documents(raw: DataFrame) -> DataFrame:
    """The inverse of ``flatten_series``: raw price rows → landed documents
    (body as JSON text), one per (symbol, month, copy) so that a document never
    holds a date twice and stays bounded (≤ 31 days), like a compact API
    response. ``fetched_at`` is the latest load time of its rows."""
    from pyspark.sql import Window
    copy = F.row_number().over(Window.partitionBy("symbol", "trade_date").orderBy("loaded_at", "close"))
    keyed = raw.withColumn("_copy", copy).withColumn("_month", F.trunc("trade_date", "month"))
    bar = F.struct(F.col("open").cast("string").alias("1. open"),
                   F.col("high").cast("string").alias("2. high"),
                   F.col("low").cast("string").alias("3. low"),
                   F.col("close").cast("string").alias("4. close"),
                   F.col("volume").cast("string").alias("5. volume"))
    docs = keyed.groupBy("symbol", "_month", "_copy").agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("trade_date").cast("string"), bar))).alias("_series"),
        F.max("loaded_at").alias("fetched_at"))
    return docs.select("symbol", "fetched_at",
                       F.to_json(F.struct(F.col("_series").alias(SERIES))).alias("body"))

"""Adapters from the provided benchmark tables onto the engine's input schemas.

The test tables carry no stock prices, so three feeds are derived from them:

* feed A – raw daily prices from ``lineitem`` (symbol per supplier, one bar per
  shipped line, reloads per (symbol, date)), watchlist from ``supplier`` ⋈ ``nation``;
* feed B – daily bars aggregated from ``events`` (dates inside a real trading
  calendar), one bar per (user, day);
* feed C – a watchlist change log from ``events``.

All three are plain projections / aggregations, so they scale with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


FEED_A_LOAD_BASE = "2002-01-01 00:00:00"
FEED_A_WATCHLIST_TS = "2002-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def feed_a_raw_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw price rows in the ``RAW_STOCK_PRICES`` layout.

    Prices are exact decimals of the line price, discounted (open, low) or
    taxed (high); the close is the line price. ``loaded_at`` encodes the load
    order (later orders and later line numbers were loaded later).
    """
    li = table(spark, sf_dir, "lineitem")
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    down = (price * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))).cast("decimal(18,4)")
    up = (price * (F.lit(1) + F.col("l_tax").cast("decimal(4,2)"))).cast("decimal(18,4)")
    load_seq = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    return li.select(
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("symbol"),
        F.col("l_shipdate").cast("date").alias("trade_date"),
        down.cast("double").alias("open"),
        up.cast("double").alias("high"),
        down.cast("double").alias("low"),
        F.col("l_extendedprice").alias("close"),
        F.col("l_quantity").cast("bigint").alias("volume"),
        F.lit("alpha_vantage").alias("source"),
        F.timestamp_add("SECOND", load_seq,
                        F.lit(FEED_A_LOAD_BASE).cast("timestamp_ntz")).alias("loaded_at"),
    )


def feed_a_watchlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Watchlist rows in the ``WATCHLIST`` layout, one per supplier. Symbols
    are lower case on purpose: staging upper-cases them."""
    sup = table(spark, sf_dir, "supplier")
    nat = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    ts = F.lit(FEED_A_WATCHLIST_TS).cast("timestamp_ntz")
    # A scan of a tiny table: the planner's file-size statistic puts it under
    # spark.sql.autoBroadcastJoinThreshold, so it is broadcast without a
    # counting job (a sort-merge join would be planned beyond the threshold).
    j = sup.join(nat, sup["s_nationkey"] == nat["n_nationkey"], "left")
    return j.select(
        F.col("s_suppkey").alias("watchlist_id"),
        F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("symbol"),
        F.col("s_name").alias("company_name"),
        F.col("n_name").alias("category"),
        F.lit(None).cast("string").alias("notes"),
        (F.col("s_acctbal") > 0).alias("is_active"),
        ts.alias("created_at"),
        ts.alias("updated_at"),
    )


def feed_b_raw_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily OHLCV bars from ``events`` in the ``RAW_STOCK_PRICES`` layout:
    open/close are the first/last value of the day, volume the event count.
    A partial aggregate runs before the shuffle, so a hot user is combined
    map-side."""
    ev = table(spark, sf_dir, "events")
    return (ev.groupBy(F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("symbol"),
                       F.col("ts").cast("date").alias("trade_date"))
            .agg(F.min_by("value", "ts").alias("open"),
                 F.max("value").alias("high"),
                 F.min("value").alias("low"),
                 F.max_by("value", "ts").alias("close"),
                 F.count(F.lit(1)).alias("volume"),
                 F.max("ts").alias("loaded_at"))
            .select("symbol", "trade_date", "open", "high", "low", "close", "volume",
                    F.lit("alpha_vantage").alias("source"), "loaded_at"))


# Event types of feed C mapped onto watchlist operations; a purchase adds too,
# with its symbol in lower case and padded and without a company name, as typed.
FEED_C_OPS = {"signup": "add", "purchase": "add", "error": "deactivate", "view": "reactivate", "click": "update"}


def feed_c_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Watchlist change log in the ``WATCHLIST_CHANGES`` layout."""
    ev = table(spark, sf_dir, "events")
    op = F.lit(None).cast("string")
    for k, v in FEED_C_OPS.items():
        op = F.when(F.col("event_type") == k, F.lit(v)).otherwise(op)
    bought = F.col("event_type") == "purchase"
    user = F.col("user_id").cast("string")
    return ev.select(F.col("event_id"),
                     F.col("ts").alias("event_ts"),
                     F.when(bought, F.concat(F.lit(" \tu"), user, F.lit(" "))).otherwise(
                         F.concat(F.lit("U"), user)).alias("symbol"),
                     op.alias("op"),
                     F.when(bought, F.lit("")).alias("company_name"),
                     F.col("event_type").alias("category"),
                     F.col("value").cast("string").alias("notes"))


def feed_c_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed C with holes: no symbol, a blank one or no time on fixed parts of
    the events."""
    part = F.pmod("event_id", F.lit(11))
    return feed_c_changes(spark, sf_dir).withColumns({
        "symbol": F.when(part == 0, F.lit(None)).when(part == 1, F.lit("  ")).when(part == 2, F.lit(""))
                   .otherwise(F.col("symbol")),
        "event_ts": F.when(part != 3, F.col("event_ts"))})


HOT_DAY = "2024-01-01"


def feed_c_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed C moved to one day, two thirds of it to one symbol."""
    day = F.lit(HOT_DAY).cast("date")
    return feed_c_changes(spark, sf_dir).withColumns({
        "event_ts": F.col("event_ts") - F.make_dt_interval(F.date_diff(F.to_date("event_ts"), day)),
        "symbol": F.when(F.pmod("event_id", F.lit(3)) < 2, "HOT").otherwise(F.col("symbol"))})

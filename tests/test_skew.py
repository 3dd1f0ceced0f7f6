"""Hot keys: results stay exact when one key holds most rows."""
import datetime as dt

from pyspark.sql import functions as F

from tickspan.operators import watchlist as wl
from tickspan.plans import staging
from tickspan.schemas import RAW_STOCK_PRICES, WATCHLIST_CHANGES


def test_hot_copy_group_dedups_to_latest(spark):
    t0 = dt.datetime(2024, 1, 3)
    hot = (spark.range(60_000).repartition(16)
           .select(F.lit("HOT").alias("symbol"), F.lit(dt.date(2024, 1, 2)).alias("trade_date"),
                   *[(F.col("id") % 997).cast("double").alias(c) for c in ("open", "high", "low", "close")],
                   F.col("id").alias("volume"), F.lit("alpha_vantage").alias("source"),
                   (F.lit(t0).cast("timestamp_ntz") + F.make_interval(secs=F.col("id") % 5000)).alias("loaded_at")))
    other = spark.createDataFrame([("X", dt.date(2024, 1, 2), 1.0, 1.0, 1.0, 1.0, 1, "alpha_vantage", t0)],
                                  RAW_STOCK_PRICES)
    out = staging.stg_stock_prices(hot.select(*RAW_STOCK_PRICES.fieldNames()).unionByName(other)).collect()
    got = {r.ticker_symbol: r for r in out}
    assert set(got) == {"HOT", "X"}
    # latest load second is 4999 (ids 4999, 9999, …); the tie is broken by the highest close
    want_close = max(i % 997 for i in range(60_000) if i % 5000 == 4999)
    assert float(got["HOT"].close_price) == want_close


def test_hot_symbol_log_spread_over_segments(spark):
    base = dt.datetime(2024, 1, 1)
    ops = ["add", "deactivate", "reactivate", "update", "deactivate", "add", "update", "reactivate"]
    rows = [(i, base + dt.timedelta(hours=7 * i), "HOT", ops[i % len(ops)], None, f"c{i}", f"n{i}")
            for i in range(3000)]
    rows += [(10_000 + i, base + dt.timedelta(hours=i), f"S{i}", "add", None, None, None) for i in range(50)]
    ch = spark.createDataFrame(rows, WATCHLIST_CHANGES).repartition(8)
    seg = sorted(wl.change_outcomes(ch, blocks=7).collect())
    one = sorted(wl.change_outcomes(ch, blocks=1).collect())
    assert seg == one
    a = {r.symbol: r for r in wl.apply_changes(ch, blocks=7).collect()}
    b = {r.symbol: r for r in wl.apply_changes(ch, blocks=1).collect()}
    assert a == b and len(a) == 51


def _one_day_log(spark, n):
    """``n`` changes of one symbol within one day, many at the same second, a part of them given twice."""
    ops = F.array(*[F.lit(o) for o in ("deactivate", "add", "update", "reactivate", "deactivate", "update", "add")])
    df = spark.range(n).select(
        (F.col("id") - F.col("id") % 2 * (F.col("id") % 100 == 1).cast("long")).alias("event_id"),
        (F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz") + F.make_interval(secs=F.col("id") % 80_000)).alias("event_ts"),
        F.lit("HOT").alias("symbol"), F.element_at(ops, (F.pmod(F.xxhash64("id"), F.lit(7)) + 1).cast("int")).alias("op"),
        F.lit(None).cast("string").alias("company_name"), F.concat(F.lit("c"), F.col("id") % 9).alias("category"),
        F.lit("").alias("notes"))
    return df.repartition(8)


def test_a_million_changes_of_one_symbol_in_a_day_fill_many_blocks(spark):
    ch = _one_day_log(spark, 1_000_000)
    ev = wl.classify_events(None, ch, blocks=16)
    # The plan after the blocks are written: no task gets more than a block.
    dealt = wl._ordered_blocks(wl._event_stream(None, ch), 16)
    sizes = [r["count"] for r in dealt.groupBy("_block").count().collect()]
    assert sum(sizes) == 1_000_000 and len(sizes) == 16 and max(sizes) < 2 * 1_000_000 / 16
    plan = ev._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(symbol" in plan and "_block" in plan
    assert ev.where("_effective").count() > 100_000
    assert wl.apply_changes(ch, blocks=16).collect() == wl.apply_changes(ch, blocks=1).collect()


def test_hot_log_is_the_row_fold(spark):
    from tests.test_watchlist import python_fold
    ch = _one_day_log(spark, 20_000)
    events = [r.asDict() for r in ch.dropDuplicates(["event_id"]).collect()]
    one = spark.createDataFrame([tuple(e[c] for c in WATCHLIST_CHANGES.fieldNames()) for e in events], WATCHLIST_CHANGES)
    want = python_fold(events)["HOT"]
    got = wl.apply_changes(one, blocks=13).first().asDict()
    assert {k: got[k] for k in want} == want


def test_equal_rows_are_split_and_change_nothing(spark):
    row = (7, dt.datetime(2024, 1, 1), "HOT", "add", None, "c", None)
    ch = spark.createDataFrame([row], WATCHLIST_CHANGES).crossJoin(spark.range(5000)).drop("id").repartition(5)
    sizes = [r["count"] for r in wl._ordered_blocks(wl._event_stream(None, ch), 8).groupBy("_block").count().collect()]
    assert max(sizes) < 2000
    n = {r.outcome: r["count"] for r in wl.change_outcomes(ch, blocks=8).groupBy("outcome").count().collect()}
    assert n == {"added": 1, "already_active": 4999}

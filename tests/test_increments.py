import datetime as dt
import random

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.helpers import raw, watchlist
from tickspan.operators import increments as inc, quality as dq
from tickspan.operators.indicators import daily_indicators
from tickspan.plans.models import PriceModels
from tickspan.plans.staging import dedup_order, renamed_prices, stage_renamed
from tickspan.sources import testfeeds

T = dt.datetime(2024, 6, 1)


def _loads(rnd, days):
    """Raw rows of three tickers over ``days`` days in random loads, some dates loaded more than once."""
    out = []
    for t in "ABC":
        for d in range(days):
            for _ in range(rnd.choice([0, 1, 1, 1, 2])):
                out.append((t, dt.date(2024, 1, 1) + dt.timedelta(days=d), float(rnd.randint(1, 50)), T + dt.timedelta(hours=rnd.randint(0, 9))))
    return out


def test_increments_equal_the_rebuild(spark):
    rnd = random.Random(4)
    for days, back in ((150, 0.1), (40, 0.5), (150, 0.0)):
        rows = _loads(rnd, days)
        cut = dt.date(2024, 1, 1) + dt.timedelta(days=days - 5)
        landed = [r for r in rows if r[1] >= cut or (rnd.random() < back and r[0] != "C")] + [("D", cut, 3.0, T)]
        base = [r for r in rows if r not in landed]
        all_rows, b, la = (renamed_prices(raw(spark, x)) for x in (base + landed, base, landed))
        want = stage_renamed(all_rows)
        assert sorted(inc.merged_latest(stage_renamed(b), la.select(*want.columns), dedup_order()).collect()) == sorted(want.collect())
        got = inc.refreshed_indicators(daily_indicators(stage_renamed(b)), la, dedup_order())

        def rounded(df):
            return sorted(map(str, df.select(*[F.round(c, 9).alias(c) if t == "double" else c for c, t in df.dtypes]).collect()))
        assert rounded(got.select(*daily_indicators(want).columns)) == rounded(daily_indicators(want))


def test_nothing_landed_changes_nothing(spark):
    staged = stage_renamed(renamed_prices(raw(spark, _loads(random.Random(1), 30))))
    stored = daily_indicators(staged)
    assert sorted(map(str, inc.refreshed_indicators(stored, staged.limit(0), dedup_order()).collect())) == sorted(map(str, stored.collect()))
    assert inc.merged_latest(staged, staged.limit(0), dedup_order()).count() == staged.count()
    older = staged.limit(1).withColumn("loaded_at", F.lit(dt.datetime(2000, 1, 1)).cast("timestamp_ntz")).withColumn("close_price", F.lit(0).cast("decimal(18,4)"))
    assert sorted(inc.merged_latest(staged, older, dedup_order()).collect()) == sorted(staged.collect())


def test_appended_rows_need_only_the_tails(spark, scratch):
    staged = stage_renamed(renamed_prices(raw(spark, _loads(random.Random(2), 200))))
    cut = dt.date(2024, 6, 1)
    old = daily_indicators(staged.where(F.col("trading_date") < F.lit(cut)))
    inc.tails(old).write.parquet(f"{scratch}/tails")
    tail = spark.read.parquet(f"{scratch}/tails")
    assert max(r["count"] for r in tail.groupBy("ticker_symbol").count().collect()) <= 51
    made = inc.appended_indicators(tail, staged.where(F.col("trading_date") >= F.lit(cut)))
    want = daily_indicators(staged).where(F.col("trading_date") >= F.lit(cut))
    for c in ("previous_close_price", "moving_average_50d", "volatility_20d"):
        a = {(r.ticker_symbol, r.trading_date): r[c] for r in made.collect()}
        b = {(r.ticker_symbol, r.trading_date): r[c] for r in want.collect()}
        assert a.keys() == b.keys() and all((a[k] is None) == (b[k] is None) and (a[k] is None or abs(float(a[k]) - float(b[k])) < 1e-9) for k in a)


def test_untouched_base_rows_are_not_shuffled(spark, scratch):
    staged = stage_renamed(renamed_prices(raw(spark, _loads(random.Random(3), 100))))
    staged.write.parquet(f"{scratch}/base")
    base = spark.read.parquet(f"{scratch}/base")
    plan = inc.merged_latest(base, base.limit(3), dedup_order())._jdf.queryExecution().executedPlan().toString()
    untouched = plan[:plan.index("LeftSemi")] if "LeftSemi" in plan else plan
    assert "BroadcastHashJoin" in untouched and "LeftAnti" in untouched


def test_stored_indicators_meet_first_changes_without_a_shuffle(spark, scratch):
    staged = stage_renamed(renamed_prices(raw(spark, _loads(random.Random(5), 100))))
    daily_indicators(staged).write.parquet(f"{scratch}/indicators")
    stored = spark.read.parquet(f"{scratch}/indicators")
    plan = inc.refreshed_indicators(stored, staged.limit(20), dedup_order())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") >= 3 and "SortMergeJoin" not in plan


def test_checks_counted_while_writing_equal_the_suite(spark, scratch):
    from tickspan.plans.build import build
    from tickspan.sources.sinks import materialize

    def models():
        items = [("A", f"2024-01-{d:02d}", float(d)) for d in range(2, 20)]
        return PriceModels(raw(spark, items), watchlist(spark, [(None, "a", True), (2, "b", True)]), calendar=("2024-01-01", "2024-12-31"))
    locs, checks = build(models(), root=f"{scratch}/a")
    plain = models()
    materialize(plain, root=f"{scratch}/b", rebind=True)
    want = sorted(map(tuple, dq.run_suite(plain).collect()))
    assert sorted(map(tuple, checks.collect())) == want and any(r[3] for r in want) and len(want) == 72
    watch = dq.Watch()
    m = models()
    materialize(m, root=f"{scratch}/c", rebind=True, watch=watch)
    parts = watch.results(m)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in parts and len(watch.seen) >= 5


def test_values_that_are_not_accepted_are_counted_as_the_suite_does(spark, scratch):
    tests = [("t", "s", "accepted_values", ["a", "b"]), ("t", "s", "not_null", None), ("t", "n", "accepted_values", [1])]
    df = spark.createDataFrame([("a", 1), ("x", 1), ("x", None), ("y", 1), (None, 1)], "s string, n int")

    class One:
        def __init__(self):
            self.spark = spark

        def model(self, name):
            return df
    watch = dq.Watch(tests)
    watch.attach("t", df).write.parquet(f"{scratch}/t")
    got = sorted(map(tuple, watch.results(One()).collect()))
    want = sorted(map(tuple, dq._union([dq.accepted_suite(One(), tests), dq.not_null_suite(One(), tests)]).collect()))
    assert got == want and [r[3] for r in want] == [0, 2, 1]

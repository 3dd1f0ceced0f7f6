from tickspan.operators import quality as dq
from tickspan.plans.models import PriceModels
from tickspan.sources import testfeeds
from tests.conftest import SF_SMALL


def test_null_keys_are_not_violations(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (None, "c"), (2, None), (2, "d")], "k int, v string")
    assert dq.unique(df, "k").collect()[0].k == 2 and dq.unique(df, "k").count() == 1
    assert dq.accepted_values(df, "v", ["a", "b", "c"]).collect()[0].value_field == "d"
    parent = spark.createDataFrame([(1,)], "k int")
    assert sorted((r.v or "") for r in dq.relationships(df, "k", parent, "k").collect()) == ["", "d"]
    assert dq.not_null(df, "k").count() == 2


def test_suite_passes_on_feed_a(spark):
    m = PriceModels(testfeeds.feed_a_raw_prices(spark, SF_SMALL), testfeeds.feed_a_watchlist(spark, SF_SMALL),
                    calendar=("1995-01-01", "2001-12-31"))
    res = dq.run_suite(m).collect()
    assert len(res) == 67 + len(dq.GRAIN_TESTS)
    assert [r for r in res if r.failures] == []


def test_grain_finds_duplicates(spark):
    df = spark.createDataFrame([("A", 1), ("A", 1), ("A", 2)], "t string, d int")
    assert [tuple(r) for r in dq.grain(df, ("t", "d")).collect()] == [("A", 1, 2)]

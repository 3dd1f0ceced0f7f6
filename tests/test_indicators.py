import datetime as dt
import math
import random
import re
from decimal import Decimal

import pytest

from tickspan.operators.indicators import daily_indicators
from tickspan.plans import staging
from tests.helpers import raw


def _ind(spark, items, split=True):
    df = daily_indicators(staging.stg_stock_prices(raw(spark, items)), split_by_year=split)
    return sorted(df.collect(), key=lambda r: (r.ticker_symbol, r.trading_date))


@pytest.mark.parametrize("split", [True, False])
def test_returns(spark, split):
    r = _ind(spark, [("A", "2024-01-02", 100.0), ("A", "2024-01-03", 110.0), ("A", "2024-01-04", 99.0)], split)
    assert [x.daily_return_pct for x in r][0] is None
    assert r[1].daily_return_pct == pytest.approx(0.1) and r[2].daily_return_pct == pytest.approx(-0.1)
    assert float(r[1].price_change) == 10.0


def test_previous_row_across_gap_and_zero_close(spark):
    r = _ind(spark, [("A", "2024-01-02", 0.0), ("A", "2024-01-09", 5.0)])
    assert float(r[1].previous_close_price) == 0.0 and float(r[1].price_change) == 5.0
    assert r[1].daily_return_pct is None


def test_moving_average_rows(spark):
    items = [("A", dt.date(2024, 1, 1) + dt.timedelta(days=i), float(i + 1)) for i in range(8)]
    r = _ind(spark, items)
    assert [r[0].moving_average_7d, r[2].moving_average_7d, r[6].moving_average_7d, r[7].moving_average_7d] == \
        [1.0, 2.0, 4.0, 5.0]


def test_volatility_first_two_rows_null(spark):
    r = _ind(spark, [("A", "2024-01-02", 100.0), ("A", "2024-01-03", 200.0), ("A", "2024-01-04", 800.0)])
    # returns NULL, 1.0, 3.0 → stddev NULL, NULL, sqrt(2)
    assert r[0].volatility_20d is None and r[1].volatility_20d is None
    assert r[2].volatility_20d == pytest.approx(math.sqrt(2))
    assert r[2].annualized_volatility_20d == pytest.approx(math.sqrt(2) * math.sqrt(252))


def test_year_split_equals_single_partition(spark):
    """The skew-safe year buckets with halos give exactly the plain result,
    including sparse years with fewer rows than the halo and a hot ticker."""
    rnd = random.Random(7)
    items = []
    for sym, n, step in (("HOT", 3000, 1), ("SPARSE", 80, 37), ("MID", 400, 3)):
        d = dt.date(1990, 1, 1)
        for _ in range(n):
            d += dt.timedelta(days=rnd.randint(1, step * 2))
            items.append((sym, d, round(rnd.uniform(1, 500), 2)))
    a = _ind(spark, items, split=True)
    b = _ind(spark, items, split=False)
    assert len(a) == len(b) == len(items)
    for x, y in zip(a, b):
        for c in ("previous_close_price", "price_change", "daily_return_pct", "moving_average_7d",
                  "moving_average_20d", "moving_average_50d"):
            assert x[c] == y[c], c
        for c in ("volatility_20d", "annualized_volatility_20d"):
            assert (x[c] is None and y[c] is None) or x[c] == pytest.approx(y[c], rel=1e-12), c


@pytest.mark.parametrize("split", [True, False])
def test_means_are_exact_over_holes_and_extremes(spark, split):
    """Means from running sums equal those of the frame's own rows, with missing
    closes and with a price that dwarfs the others before the frame."""
    rnd = random.Random(11)
    top = Decimal("99999999999999.9999")
    rows = []
    for s in ("A", "B", None):
        for i in range(160):
            close = None if i % 7 == 3 or i < 2 else top if i == 5 else -top if i == 40 else Decimal(rnd.randrange(10 ** 8)).scaleb(-4)
            rows.append((s, dt.date(2023, 10, 1) + dt.timedelta(days=i), close))
    df = spark.createDataFrame(rows, "ticker_symbol string, trading_date date, close_price decimal(18,4)")
    got = {(r.ticker_symbol, r.trading_date): r for r in daily_indicators(df, split_by_year=split).collect()}
    assert len(got) == len(rows)
    for s in ("A", "B", None):
        mine = [r for r in rows if r[0] == s]
        for i, (_, day, _) in enumerate(mine):
            if s is None and split and day.year == 2024 and i < 92 + 49:
                continue
            for name, n in (("moving_average_7d", 7), ("moving_average_20d", 20), ("moving_average_50d", 50)):
                known = [c for _, _, c in mine[max(0, i - n + 1):i + 1] if c is not None]
                want = float(sum(known)) / len(known) if known else None
                assert got[s, day][name] == want, (s, day, name)


def test_no_frame_adds_up_its_rows_for_every_mean(spark):
    plan = daily_indicators(staging.stg_stock_prices(raw(spark, [("A", "2024-01-02", 1.0)])))._jdf.queryExecution().executedPlan().toString()
    assert "RowFrame, -50, -50" in plan
    assert not re.search(r"(sum|count)\([^\n]{0,200}?RowFrame, -(6|19|49), currentrow", plan)


def test_year_buckets_shuffle_their_rows_once(spark):
    """Rows beyond the first of a year are read back as the first pass made them."""
    items = [("A", dt.date(2023, 6, 1) + dt.timedelta(days=i), float(i + 1)) for i in range(400)]
    plan = daily_indicators(staging.stg_stock_prices(raw(spark, items)), split_by_year=True)._jdf.queryExecution().optimizedPlan().toString()
    body = plan[:plan.index("_is_halo")]
    assert "Window" not in body and "parquet" in body

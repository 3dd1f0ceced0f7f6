import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tickspan import functions as tf
from tickspan.schemas import PRICE


def test_safe_divide_nulls(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (None, 2.0), (0.0, 0.0), (3.0, 2.0)], "n double, d double")
    got = [r[0] for r in df.select(tf.safe_divide("n", "d")).collect()]
    assert got == [None, None, None, None, 1.5]


def test_price_cast_rounds_half_up(spark):
    df = spark.createDataFrame([(1.00005,), (2.12345,), (-1.00005,)], "x double")
    got = [r[0] for r in df.select(F.col("x").cast(PRICE)).collect()]
    assert got == [Decimal("1.0001"), Decimal("2.1235"), Decimal("-1.0001")]


def test_text_helpers(spark):
    df = spark.createDataFrame([(" nvda ", ""), ("\tmsft\n", " x")], "s string, c string")
    got = df.select(tf.normalize_symbol("s"), tf.blank_to_null("c")).collect()
    assert [tuple(r) for r in got] == [("NVDA", None), ("MSFT", " x")]


def test_date_helpers(spark):
    df = spark.createDataFrame([(dt.date(2024, 12, 30),), (dt.date(2024, 2, 29),), (dt.date(2027, 12, 31),)], "d date")
    got = df.select(tf.date_key("d"), tf.iso_day_of_week("d"), tf.week_start("d"), tf.week_end("d"),
                    tf.quarter_end("d"), tf.year_end("d"), tf.one_year_before("d"),
                    tf.month_short_name("d"), tf.day_short_name("d"), tf.day_name("d"),
                    F.weekofyear("d")).collect()
    a, b, c = [tuple(r) for r in got]
    assert a[:2] == (20241230, 1) and a[2] == dt.date(2024, 12, 30) and a[3] == dt.date(2025, 1, 5)
    assert a[-1] == 1  # ISO week of 2024-12-30
    assert b[4] == dt.date(2024, 3, 31) and b[6] == dt.date(2023, 2, 28)
    assert b[7:10] == ("Feb", "Thu", "Thursday")
    assert c[5] == dt.date(2027, 12, 31) and c[-1] == 52


def test_display_strings(spark):
    df = spark.createDataFrame([(0.01234, 1234.5)], "r double, p double")
    got = df.select(tf.signed_percent("r"), tf.percent("r"), tf.currency("p"), tf.whole_number("p")).first()
    assert tuple(got) == ("+1.23%", "1.23%", "$1,234.50", "{:,.0f}".format(1234.5))


def test_display_strings_print_as_python_does(spark):
    import math
    import random
    rnd = random.Random(4)
    values = [None, 0.0, -0.0, 0.00125, -0.00125, 0.00375, 2.675, 1.005, 12.5, -12.5, 1234567.125, -0.00001, math.nan,
              1e12, 123.456] + [rnd.uniform(-2, 2) for _ in range(500)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = df.select("i", tf.signed_percent("v"), tf.signed_percent("v", 4), tf.percent("v"), tf.currency("v"),
                    tf.whole_number("v")).collect()
    for i, *shown in got:
        v = math.nan if values[i] is None else values[i]
        assert shown == [f"{v * 100:+.2f}%", f"{v * 100:+.4f}%", f"{v * 100:.2f}%", f"${v:,.2f}", f"{v:,.0f}"], values[i]


def test_date_helpers_match_python_on_random_dates(spark):
    import calendar
    import random
    rnd = random.Random(11)
    days = [dt.date(1900, 1, 1) + dt.timedelta(days=rnd.randint(0, 73000)) for _ in range(3000)]
    days += [dt.date(2024, 2, 29), dt.date(2000, 2, 29), dt.date(1900, 3, 1), dt.date(2027, 12, 31)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = df.select("d", tf.date_key("d").alias("k"), tf.iso_day_of_week("d").alias("dow"),
                    F.weekofyear("d").alias("wk"), tf.week_start("d").alias("ws"), tf.week_end("d").alias("we"),
                    tf.month_end("d").alias("me"), tf.quarter_start("d").alias("qs"), tf.quarter_end("d").alias("qe"),
                    tf.year_end("d").alias("ye"), tf.one_year_before("d").alias("y1"),
                    tf.month_name("d").alias("mn"), tf.day_short_name("d").alias("dn")).collect()
    for r in got:
        d = r.d
        assert r.k == d.year * 10000 + d.month * 100 + d.day
        assert r.dow == d.isoweekday() and r.wk == d.isocalendar()[1]
        assert r.ws == d - dt.timedelta(days=d.weekday()) and r.we == r.ws + dt.timedelta(days=6)
        assert r.me == d.replace(day=calendar.monthrange(d.year, d.month)[1])
        q0 = 3 * ((d.month - 1) // 3) + 1
        assert r.qs == dt.date(d.year, q0, 1)
        assert r.qe == dt.date(d.year, q0 + 2, calendar.monthrange(d.year, q0 + 2)[1])
        assert r.ye == dt.date(d.year, 12, 31)
        try:
            want = d.replace(year=d.year - 1)
        except ValueError:  # 29 February
            want = dt.date(d.year - 1, 2, 28)
        assert r.y1 == want
        assert r.mn == calendar.month_name[d.month] and r.dn == calendar.day_abbr[d.weekday()]

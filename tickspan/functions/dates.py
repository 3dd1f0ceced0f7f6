"""Calendar helpers on DATE columns. Weeks start on Monday (ISO)."""

from pyspark.sql import Column, functions as F

from tickspan.functions._col import as_col


def date_key(d) -> Column:
    """Integer key YYYYMMDD, computed arithmetically (no string formatting)."""
    d = as_col(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def iso_day_of_week(d) -> Column:
    """1 = Monday .. 7 = Sunday."""
    return (F.weekday(as_col(d)) + 1).cast("int")


def week_start(d) -> Column:
    return F.trunc(as_col(d), "week")


def week_end(d) -> Column:
    return F.date_add(week_start(d), 6)


def month_start(d) -> Column:
    return F.trunc(as_col(d), "month")


def month_end(d) -> Column:
    return F.last_day(as_col(d))


def quarter_start(d) -> Column:
    return F.trunc(as_col(d), "quarter")


def quarter_end(d) -> Column:
    return F.last_day(F.add_months(quarter_start(d), 2))


def year_start(d) -> Column:
    return F.trunc(as_col(d), "year")


def year_end(d) -> Column:
    return F.make_date(F.year(as_col(d)), F.lit(12), F.lit(31))


def one_year_before(d) -> Column:
    """Same day a year earlier; 29 February maps to 28 February."""
    return F.add_months(as_col(d), -12)


def month_name(d) -> Column:
    return F.date_format(as_col(d), "MMMM")


def month_short_name(d) -> Column:
    return F.date_format(as_col(d), "MMM")


def day_name(d) -> Column:
    return F.date_format(as_col(d), "EEEE")


def day_short_name(d) -> Column:
    return F.date_format(as_col(d), "EEE")

"""Display strings for report tables (percent, currency, counts)."""

from pyspark.sql import Column, functions as F

from tickspan.functions._col import as_col


def grouped(x: Column, digits: int) -> Column:
    """1234.5 -> '1,234.50'. ``format_number`` rounds the double's exact value
    half to even (0.125 -> '0.12'); a missing value or NaN prints 'nan'."""
    return F.when(x.isNull() | F.isnan(x), F.lit("nan")).otherwise(F.format_number(x, digits))


def signed_percent(c, digits: int = 2) -> Column:
    """0.0123 -> '+1.23%'; missing -> '+nan%'."""
    x = as_col(c).cast("double") * 100
    text = F.replace(grouped(x, digits), F.lit(","), F.lit(""))
    return F.concat(F.when(F.startswith(text, F.lit("-")), F.lit("")).otherwise(F.lit("+")), text, F.lit("%"))


def percent(c, digits: int = 2) -> Column:
    """0.0123 -> '1.23%'; missing -> 'nan%'."""
    return F.concat(F.replace(grouped(as_col(c).cast("double") * 100, digits), F.lit(","), F.lit("")), F.lit("%"))


def currency(c, digits: int = 2) -> Column:
    """1234.5 -> '$1,234.50'; missing -> '$nan'."""
    return F.concat(F.lit("$"), grouped(as_col(c).cast("double"), digits))


def whole_number(c) -> Column:
    """1234.6 -> '1,235'; missing -> 'nan'."""
    return grouped(as_col(c).cast("double"), 0)

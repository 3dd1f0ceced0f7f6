"""Text helpers for user-entered watchlist fields."""

from pyspark.sql import Column, functions as F

from tickspan.functions._col import as_col


def blank_to_null(c) -> Column:
    """An empty string becomes NULL (other strings, even blank ones, are kept)."""
    return F.nullif(as_col(c), F.lit(""))


def strip_all(c) -> Column:
    """Remove leading and trailing white space of any kind (Unicode-aware)."""
    return F.regexp_replace(as_col(c), r"(?U)^\s+|\s+$", "")


def normalize_symbol(c) -> Column:
    """Symbol as entered in the add form: upper-cased, then stripped."""
    return strip_all(F.upper(as_col(c)))

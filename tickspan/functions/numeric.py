"""Numeric helpers.

Number semantics are decided once for the whole engine: ratios are computed on
doubles (one division after casting both decimal operands), averages of decimal
prices are ``cast(sum(decimal) as double) / count`` so that the exact decimal sum
is rounded only once, and division by zero or NULL yields NULL.
"""

from pyspark.sql import Column, functions as F

from tickspan.functions._col import as_col


def as_double(c) -> Column:
    return as_col(c).cast("double")


def safe_divide(numerator, denominator) -> Column:
    """NULL when the denominator is 0 or NULL, else numerator / denominator,
    evaluated in double precision. ``try_divide`` covers both cases without
    raising under ANSI mode."""
    return F.try_divide(as_double(numerator), as_double(denominator))


def decimal_mean(c, window=None) -> Column:
    """Mean of a decimal column as a double: exact decimal sum, then one
    division. Works as an aggregate or, given ``window``, over a frame."""
    c = as_col(c)
    s, n = F.sum(c), F.count(c)
    if window is not None:
        s, n = s.over(window), n.over(window)
    return F.try_divide(s.cast("double"), n.cast("double"))


def rounded(c, digits: int = 6) -> Column:
    return F.round(as_col(c), digits)

"""Column-expression helpers. All are built-in Spark expressions (JVM side,
inside whole-stage codegen); none is a Python UDF."""

from tickspan.functions.numeric import (
    safe_divide, as_double, decimal_mean, rounded,
)
from tickspan.functions.text import blank_to_null, strip_all, normalize_symbol
from tickspan.functions.dates import (
    date_key, iso_day_of_week, week_start, week_end, month_start, month_end,
    quarter_start, quarter_end, year_start, year_end, one_year_before,
    month_name, month_short_name, day_name, day_short_name,
)
from tickspan.functions.display import signed_percent, percent, currency, whole_number

__all__ = [
    "safe_divide", "as_double", "decimal_mean", "rounded",
    "blank_to_null", "strip_all", "normalize_symbol",
    "date_key", "iso_day_of_week", "week_start", "week_end", "month_start", "month_end",
    "quarter_start", "quarter_end", "year_start", "year_end", "one_year_before",
    "month_name", "month_short_name", "day_name", "day_short_name",
    "signed_percent", "percent", "currency", "whole_number",
]

"""Join helpers: broadcast only behind a size check, with a shuffle join beyond it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

# Ceiling for a broadcast side, in bytes (like spark.sql.autoBroadcastJoinThreshold)
# and in rows (the largest count ever taken). The row cap of one join is the byte
# budget divided by a conservative width of the side's projected row.
DEFAULT_MAX_BROADCAST_BYTES = 64 * 1024 * 1024
DEFAULT_MAX_BROADCAST_ROWS = 2_000_000
STRING_BYTES = 64          # assumed width of a string value (symbols, names, notes)


def row_bytes(schema: T.StructType) -> int:
    """Conservative in-memory width of one row of ``schema`` (plus a fixed
    per-row overhead)."""
    def width(dt: T.DataType) -> int:
        if isinstance(dt, T.StringType):
            return STRING_BYTES
        if isinstance(dt, (T.StructType,)):
            return sum(width(f.dataType) for f in dt.fields)
        if isinstance(dt, (T.ArrayType, T.MapType, T.BinaryType)):
            return 8 * STRING_BYTES
        if isinstance(dt, T.DecimalType):
            return 16
        return 8                # numbers, dates, timestamps, booleans
    return 16 + sum(width(f.dataType) for f in schema.fields)


def broadcast_row_cap(df: DataFrame, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> int:
    return max(1, min(DEFAULT_MAX_BROADCAST_ROWS, max_bytes // row_bytes(df.schema)))


def fits(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows: a partial count of a
    side that is expected to be small, taken anew for every join."""
    return df.count() <= max_rows


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner",
               max_rows: int | None = None, known_rows: int | None = None,
               max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Join ``big`` with a side expected to be small.

    ``small`` is broadcast only if its size is proven: either ``known_rows`` (a
    bound known from parameters, e.g. a calendar's day count, or the count of
    the table it is projected from) or a count shows at most the row cap – ``max_rows`` if given, else ``max_bytes`` over the width of a row of
    ``small``. Otherwise a regular shuffle join is planned (AQE may still
    convert it at run time)."""
    cap = broadcast_row_cap(small, max_bytes) if max_rows is None else max_rows
    n_ok = (known_rows <= cap) if known_rows is not None else fits(small, cap)
    return big.join(F.broadcast(small) if n_ok else small, on, how)

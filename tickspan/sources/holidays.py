"""Market holiday seed (S6): a small versioned CSV, read with an explicit schema."""

from __future__ import annotations

import csv
import datetime as dt
import io

from pyspark.sql import DataFrame, SparkSession

from tickspan.schemas import MARKET_HOLIDAYS

# ---------------------------------------------------------------------------
# The NYSE full-day closures 2024-2027 shipped as the seed. They
# must equal the reference's seed for calendar results to match.
# ---------------------------------------------------------------------------
MARKET_HOLIDAYS_CSV = """\
holiday_date,market_code,holiday_name,is_full_day_closure,is_early_close
2024-01-01,NYSE,New Year's Day,true,false
2024-01-15,NYSE,Martin Luther King Jr. Day,true,false
2024-02-19,NYSE,Presidents' Day,true,false
2024-03-29,NYSE,Good Friday,true,false
2024-05-27,NYSE,Memorial Day,true,false
2024-06-19,NYSE,Juneteenth National Independence Day,true,false
2024-07-04,NYSE,Independence Day,true,false
2024-09-02,NYSE,Labor Day,true,false
2024-11-28,NYSE,Thanksgiving Day,true,false
2024-12-25,NYSE,Christmas Day,true,false
2025-01-01,NYSE,New Year's Day,true,false
2025-01-09,NYSE,National Day of Mourning (Jimmy Carter),true,false
2025-01-20,NYSE,Martin Luther King Jr. Day,true,false
2025-02-17,NYSE,Presidents' Day,true,false
2025-04-18,NYSE,Good Friday,true,false
2025-05-26,NYSE,Memorial Day,true,false
2025-06-19,NYSE,Juneteenth National Independence Day,true,false
2025-07-04,NYSE,Independence Day,true,false
2025-09-01,NYSE,Labor Day,true,false
2025-11-27,NYSE,Thanksgiving Day,true,false
2025-12-25,NYSE,Christmas Day,true,false
2026-01-01,NYSE,New Year's Day,true,false
2026-01-19,NYSE,Martin Luther King Jr. Day,true,false
2026-02-16,NYSE,Presidents' Day,true,false
2026-04-03,NYSE,Good Friday,true,false
2026-05-25,NYSE,Memorial Day,true,false
2026-06-19,NYSE,Juneteenth National Independence Day,true,false
2026-07-03,NYSE,Independence Day (observed),true,false
2026-09-07,NYSE,Labor Day,true,false
2026-11-26,NYSE,Thanksgiving Day,true,false
2026-12-25,NYSE,Christmas Day,true,false
2027-01-01,NYSE,New Year's Day,true,false
2027-01-18,NYSE,Martin Luther King Jr. Day,true,false
2027-02-15,NYSE,Presidents' Day,true,false
2027-03-26,NYSE,Good Friday,true,false
2027-05-31,NYSE,Memorial Day,true,false
2027-06-18,NYSE,Juneteenth National Independence Day (observed),true,false
2027-07-05,NYSE,Independence Day (observed),true,false
2027-09-06,NYSE,Labor Day,true,false
2027-11-25,NYSE,Thanksgiving Day,true,false
2027-12-24,NYSE,Christmas Day (observed),true,false
"""


def seed_rows(text: str = MARKET_HOLIDAYS_CSV) -> list[tuple]:
    """Parse seed CSV text into typed tuples (used for the built-in seed and
    for inlining the seed into oracle SQL)."""
    out = []
    for r in csv.DictReader(io.StringIO(text)):
        out.append((
            dt.date.fromisoformat(r["holiday_date"]),
            r["market_code"],
            r["holiday_name"] or None,
            r["is_full_day_closure"].strip().lower() == "true",
            r["is_early_close"].strip().lower() == "true",
        ))
    return out


def market_holidays(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The holiday seed. With ``path``, read a CSV of the same layout from
    storage (explicit schema, header); otherwise use the built-in seed."""
    if path:
        return (spark.read.schema(MARKET_HOLIDAYS).option("header", True)
                .option("mode", "FAILFAST").csv(path))
    return spark.createDataFrame(seed_rows(), MARKET_HOLIDAYS)


def seed_size(text: str = MARKET_HOLIDAYS_CSV) -> int:
    return len(seed_rows(text))


def holidays_values_sql(text: str = MARKET_HOLIDAYS_CSV) -> str:
    """The seed as an SQL ``VALUES`` relation (for oracle queries)."""
    rows = []
    for d, m, name, full, early in seed_rows(text):
        nm = "NULL" if name is None else "'" + name.replace("'", "''") + "'"
        rows.append(f"(DATE '{d.isoformat()}', '{m}', {nm}, {str(full).upper()}, {str(early).upper()})")
    return ("(VALUES " + ", ".join(rows) +
            ") AS h(holiday_date, market_code, holiday_name, is_full_day_closure, is_early_close)")

import collections
import datetime as dt
import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tickspan.plans import catalog

# Queries of the optional text subpackage are tested next to their operators.
NAMES = sorted(catalog.QUERIES)


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v != 0 else "0"
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF_SMALL):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{SF_SMALL}/{f}')")
    return con


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "period_name" in df.columns


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(E.queries()) and set(NAMES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    got = df.collect()
    rel = duck.sql(E.oracle_sql()[name])
    cols, ocols = df.columns, list(rel.columns)
    assert sorted(cols) == sorted(ocols)
    want = rel.fetchall()
    idx = [ocols.index(c) for c in cols]
    a = collections.Counter(tuple(_norm(r[c]) for c in cols) for r in got)
    b = collections.Counter(tuple(_norm(r[i]) for i in idx) for r in want)
    assert a == b


def test_violating_inputs_are_found(spark):
    """Every kind of check meets violations on inputs that have them."""
    found = {}
    for r in catalog.QUERIES["dq_violations"](spark, SF_SMALL).collect():
        found[r.test] = found.get(r.test, 0) + r.failures
    assert set(found) == {"not_null", "unique", "accepted_values", "relationships", "unique_grain"}
    assert all(n > 0 for n in found.values()), found


@pytest.mark.parametrize("name", ["watchlist_listing", "watchlist_listing_active", "active_symbols", "summary_ordered",
                                  "ticker_history_90d"])
def test_ordered_queries_are_in_order(spark, name):
    key = {"watchlist_listing": lambda r: (not r.is_active, r.symbol), "watchlist_listing_active": lambda r: r.symbol,
           "active_symbols": lambda r: r.symbol, "summary_ordered": lambda r: (r.ticker_symbol, r.period_rank),
           "ticker_history_90d": lambda r: (r.ticker_symbol, r.trading_date)}[name]
    got = [key(r) for r in catalog.QUERIES[name](spark, SF_SMALL).collect()]
    assert got == sorted(got) and got


def test_bench_prints_one_json_line(spark, monkeypatch, capsys):
    import json
    import sys

    import bench
    monkeypatch.setenv("BENCH_SF_DIR", SF_SMALL)
    monkeypatch.setenv("BENCH_REPEAT", "1")
    monkeypatch.setattr(sys, "argv", ["bench.py", "dim_date", "period_summary"])
    bench.main()
    out = capsys.readouterr().out.strip().splitlines()
    assert len(out) == 1
    d = json.loads(out[0])
    assert d["unit"] == "sec" and set(d["queries"]) == {"dim_date", "period_summary"} and d["value"] > 0

"""Command line: the two jobs a deployment runs.

    python -m tickspan ingest --landed DIR --raw DIR --rejects DIR [--checkpoint DIR]
    python -m tickspan build --raw DIR --watchlist DIR --out DIR [--calendar START END] [--versioned]
    python -m tickspan seed-watchlist --watchlist DIR [--load-ts TS]
    python -m tickspan apply-changes --watchlist DIR --changes DIR --out DIR

``ingest`` lands every new API document in the raw price table (incremental; a
batch that is repeated after a failure replaces itself). ``build`` rebuilds every layer from the raw
prices and the watchlist, then runs the data-quality checks on the written
tables, writes them under ``<out>/CHECKS`` and exits non-zero on failures; with
``--versioned`` readers keep the tables they have open, and a build that fails
changes nothing.
``seed-watchlist`` appends the starter tickers that are not yet present
(creating the watchlist if the folder is empty). ``apply-changes`` folds a
change log into the watchlist and writes the next snapshot to ``--out``. With
``--out`` equal to ``--watchlist`` the snapshot becomes the folder's next version:
the rows it is computed from stay until it is published.
"""

from __future__ import annotations

import argparse
import sys


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="tickspan")
    sub = p.add_subparsers(dest="cmd", required=True)
    i = sub.add_parser("ingest")
    i.add_argument("--landed", required=True)
    i.add_argument("--raw", required=True)
    i.add_argument("--rejects", required=True)
    i.add_argument("--checkpoint")
    b = sub.add_parser("build")
    b.add_argument("--raw", required=True)
    b.add_argument("--watchlist", required=True)
    b.add_argument("--out", required=True)
    b.add_argument("--holidays")
    b.add_argument("--calendar", nargs=2, metavar=("START", "END"))
    b.add_argument("--market", default="NYSE")
    b.add_argument("--versioned", action="store_true")
    sd = sub.add_parser("seed-watchlist")
    sd.add_argument("--watchlist", required=True)
    sd.add_argument("--load-ts")
    ac = sub.add_parser("apply-changes")
    ac.add_argument("--watchlist", required=True)
    ac.add_argument("--changes", required=True)
    ac.add_argument("--out", required=True)
    a = p.parse_args(argv)

    from pyspark.sql import functions as F

    from tickspan.session import get_session
    spark = get_session(app_name=f"tickspan-{a.cmd}")
    if a.cmd == "ingest":
        from tickspan.streaming.ingest import run_once
        run_once(spark, a.landed, a.raw, a.rejects, a.checkpoint)
        return 0
    if a.cmd in ("seed-watchlist", "apply-changes"):
        return _watchlist_job(spark, a)

    from tickspan.plans.build import build
    from tickspan.plans.models import PriceModels
    from tickspan.schemas import RAW_STOCK_PRICES
    from tickspan.sources.holidays import market_holidays
    raw = spark.read.parquet(a.raw).select(*[F.col(f.name).cast(f.dataType) for f in RAW_STOCK_PRICES])
    wl = _read_watchlist(spark, a.watchlist, may_be_new=False)
    hol = market_holidays(spark, a.holidays) if a.holidays else None
    models = PriceModels(raw, wl, hol, calendar=tuple(a.calendar) if a.calendar else None, market_code=a.market)
    locations, checks = build(models, root=a.out, versioned=a.versioned)
    checks.write.mode("overwrite").parquet(f"{a.out.rstrip('/')}/CHECKS")
    failed = spark.read.parquet(f"{a.out.rstrip('/')}/CHECKS").where(F.col("failures") > 0).count()
    print(f"built {len(locations)} models; {failed} failing checks")
    return 1 if failed else 0


def _read_watchlist(spark, path, may_be_new):
    """The watchlist; only the seeding job may start from none."""
    from pyspark.sql import functions as F

    from tickspan.schemas import WATCHLIST
    from tickspan.sources import versions
    from tickspan.sources.sinks import has_files
    if versions.is_versioned(spark, path):
        path = versions.current(spark, path)
    if not has_files(spark, path):
        if not may_be_new:
            raise FileNotFoundError(f"no watchlist at {path}")
        return spark.createDataFrame([], WATCHLIST)
    return spark.read.parquet(path).select(*[F.col(f.name).cast(f.dataType) for f in WATCHLIST])


def _watchlist_job(spark, a) -> int:
    from pyspark.sql import functions as F

    from tickspan.operators import watchlist as wl
    from tickspan.schemas import WATCHLIST_CHANGES
    from tickspan.sources import versions
    current = _read_watchlist(spark, a.watchlist, may_be_new=a.cmd == "seed-watchlist")
    if a.cmd == "seed-watchlist":
        from tickspan.sources.starter import starter_tickers
        before = current.count()
        new = wl.insert_if_absent(current, starter_tickers(spark), load_ts=a.load_ts)
        if versions.is_versioned(spark, a.watchlist):
            versions.replace_table(current.unionByName(new), a.watchlist)
        else:
            new.write.mode("append").parquet(a.watchlist)
        print(f"seeded {_read_watchlist(spark, a.watchlist, True).count() - before} tickers")
        return 0
    changes = spark.read.parquet(a.changes).select(*[F.col(f.name).cast(f.dataType) for f in WATCHLIST_CHANGES])
    snapshot = wl.apply_changes(changes, snapshot=current)
    if versions.is_versioned(spark, a.out) or _same_folder(spark, a.out, a.watchlist):
        versions.replace_table(snapshot, a.out)
    else:
        snapshot.write.mode("overwrite").parquet(a.out)
    return 0


def _same_folder(spark, a, b) -> bool:
    from tickspan.sources.versions import file_system
    (fa, pa), (fb, pb) = file_system(spark, a), file_system(spark, b)
    return fa.makeQualified(pa).toString().rstrip("/") == fb.makeQualified(pb).toString().rstrip("/")


if __name__ == "__main__":
    sys.exit(main())

import datetime as dt

from pyspark.sql import functions as F

from tickspan.operators import watchlist as wl
from tickspan.schemas import WATCHLIST_CHANGES
from tickspan.sources import testfeeds
from tests.conftest import SF_MID

T = dt.datetime(2024, 1, 1)


def _changes(spark, ops):
    rows = [(i, T + dt.timedelta(hours=i), s, op, cn, cat, n) for i, (s, op, cn, cat, n) in enumerate(ops)]
    return spark.createDataFrame(rows, WATCHLIST_CHANGES)


def python_fold(events, snapshot=None):
    """Row-by-row reference fold (the add/deactivate/reactivate/update calls)."""
    state = {r["symbol"]: dict(r) for r in (snapshot or [])}
    next_id = max([r["watchlist_id"] for r in state.values()] or [0])
    new_syms = []
    for e in sorted(events, key=lambda e: (e["event_ts"], e["event_id"])):
        op, ts = e["op"], e["event_ts"]
        attrs = {k: (e[k] or None) for k in ("company_name", "category", "notes")}
        if op == "add":
            s = e["symbol"].upper().strip()
            cur = state.get(s)
            if cur is None:
                state[s] = dict(watchlist_id=None, symbol=s, is_active=True, created_at=ts, updated_at=ts, **attrs)
                new_syms.append(s)
            elif not cur["is_active"]:
                cur.update(is_active=True, updated_at=ts, **attrs)
        else:
            cur = state.get(e["symbol"])
            if cur is None:
                continue
            if op == "deactivate" and cur["is_active"]:
                cur.update(is_active=False, updated_at=ts)
            elif op == "reactivate" and not cur["is_active"]:
                cur.update(is_active=True, updated_at=ts)
            elif op == "update":
                cur.update(updated_at=ts, **attrs)
    for s in sorted(new_syms):
        next_id += 1
        state[s]["watchlist_id"] = next_id
    return state


def _as_dict(df):
    return {r.symbol: r.asDict() for r in df.collect()}


def test_operation_sequence(spark):
    ops = [(" nvda ", "add", "Nvidia", "", "gpu"), ("NVDA", "add", "X", "Y", "Z"),
           ("NVDA", "deactivate", None, None, None), ("NVDA", "deactivate", None, None, None),
           ("nvda", "add", "Nvidia Corp", "Semis", ""), ("NVDA", "update", "N", "C", "note"),
           ("MSFT", "reactivate", None, None, None), ("MSFT", "update", "M", "C", "n")]
    ch = _changes(spark, ops)
    snap = _as_dict(wl.apply_changes(ch))
    assert list(snap) == ["NVDA"]
    n = snap["NVDA"]
    assert (n["watchlist_id"], n["is_active"], n["company_name"], n["category"], n["notes"]) == (1, True, "N", "C", "note")
    assert n["created_at"] == T and n["updated_at"] == T + dt.timedelta(hours=5)
    out = [r.outcome for r in wl.change_outcomes(ch).orderBy("event_id").collect()]
    assert out == ["added", "already_active", "deactivated", "already_inactive", "reactivated", "updated",
                   "not_found", "not_found"]


def test_add_normalizes_and_blanks_become_null(spark):
    r = wl.apply_changes(_changes(spark, [(" nvda ", "add", "", "", " keep ")])).first()
    assert (r.symbol, r.company_name, r.category, r.notes) == ("NVDA", None, None, " keep ")


def test_closed_form_equals_row_fold_on_feed_c(spark):
    ch = testfeeds.feed_c_changes(spark, SF_MID)
    events = [r.asDict() for r in ch.collect()]
    want = python_fold(events)
    got = _as_dict(wl.apply_changes(ch))
    assert got.keys() == want.keys()
    for s in want:
        for k in ("watchlist_id", "is_active", "company_name", "category", "notes", "created_at", "updated_at"):
            assert got[s][k] == want[s][k], (s, k)
    assert sum(v["is_active"] for v in got.values()) == 117


def test_two_step_fold_equals_one_step(spark):
    ch = testfeeds.feed_c_changes(spark, SF_MID)
    one = _as_dict(wl.apply_changes(ch))
    cut = dt.datetime(2024, 1, 15)
    first = wl.apply_changes(ch.where(F.col("event_ts") < F.lit(cut)))
    two = _as_dict(wl.apply_changes(ch.where(F.col("event_ts") >= F.lit(cut)), snapshot=first))
    assert one.keys() == two.keys()
    for s in one:
        for k in ("is_active", "company_name", "category", "notes", "created_at", "updated_at"):
            assert one[s][k] == two[s][k], (s, k)


def test_insert_if_absent_numbers_new_keys_only(spark):
    cur = wl.apply_changes(_changes(spark, [("AAA", "add", None, None, None), ("BBB", "add", None, None, None)]))
    cands = spark.createDataFrame([("CCC", None, None, None), ("AAA", "x", None, None), ("ABC", None, None, None)],
                                  "symbol string, company_name string, category string, notes string")
    got = sorted((r.watchlist_id, r.symbol) for r in wl.insert_if_absent(cur, cands, load_ts="2024-02-01").collect())
    assert got == [(3, "ABC"), (4, "CCC")]


def test_assign_ids_dense_across_partitions(spark):
    df = spark.range(5000).select(F.lit(None).cast("bigint").alias("watchlist_id"),
                                  F.format_string("K%05d", (F.col("id") * 7919) % 5000).alias("symbol"),
                                  *[F.lit(None).cast("string").alias(c) for c in ("company_name", "category", "notes")],
                                  F.lit(True).alias("is_active"),
                                  F.lit(T).alias("created_at"), F.lit(T).alias("updated_at")).repartition(7)
    got = sorted((r.symbol, r.watchlist_id) for r in wl.assign_ids(df, 100).collect())
    assert [i for _, i in got] == list(range(101, 5101))


def test_segmented_scan_equals_per_symbol_scan(spark):
    ch = testfeeds.feed_c_changes(spark, SF_MID)
    for blocks in (3, 16, None):
        a = sorted(wl.change_outcomes(ch, blocks=blocks).collect())
        b = sorted(wl.change_outcomes(ch, blocks=1).collect())
        assert a == b
    snap = wl.apply_changes(ch.where(F.col("op") == "add"), blocks=1)
    rest = ch.where(F.col("op") != "add")
    assert sorted(wl.apply_changes(rest, snap).collect()) == sorted(wl.apply_changes(rest, snap, blocks=1).collect())


def test_random_logs_match_row_fold(spark):
    """Many random change logs at once (random snapshots, case variants,
    blanks, same-second events): closed form = row-by-row fold."""
    import random
    rnd = random.Random(20241203)
    ops = ["add", "add", "deactivate", "reactivate", "update"]
    events, snap = [], []
    base = dt.datetime(2024, 3, 1)
    for k in range(300):
        sym = f"K{k:03d}"
        if rnd.random() < 0.3:
            created = base - dt.timedelta(days=rnd.randint(1, 30))
            snap.append(dict(watchlist_id=k + 1, symbol=sym, company_name=f"seed{k}", category=None, notes=None,
                             is_active=rnd.random() < 0.5, created_at=created, updated_at=created))
        t = base
        for _ in range(rnd.randint(1, 12)):
            t += dt.timedelta(hours=rnd.choice([0, 1, 5, 30]))
            op = rnd.choice(ops)
            shown = rnd.choice([sym, sym.lower(), f" {sym} "]) if op == "add" else sym
            attrs = [rnd.choice(["", None, f"v{rnd.randint(0, 9)}"]) for _ in range(3)]
            events.append(dict(event_id=len(events), event_ts=t, symbol=shown, op=op,
                               company_name=attrs[0], category=attrs[1], notes=attrs[2]))
    from tickspan.schemas import WATCHLIST
    snap_df = spark.createDataFrame([tuple(r[c] for c in WATCHLIST.fieldNames()) for r in snap], WATCHLIST)
    ch = spark.createDataFrame([tuple(e[c] for c in WATCHLIST_CHANGES.fieldNames()) for e in events],
                               WATCHLIST_CHANGES)
    want = python_fold(events, snapshot=[dict(r) for r in snap])
    got = _as_dict(wl.apply_changes(ch, snapshot=snap_df))
    assert got.keys() == want.keys()
    for s in want:
        for k in ("watchlist_id", "is_active", "company_name", "category", "notes", "created_at", "updated_at"):
            assert got[s][k] == want[s][k], (s, k, got[s][k], want[s][k])


def test_empty_symbol_add_is_refused(spark):
    ch = _changes(spark, [("  ", "add", "X", None, None), ("AAA", "add", None, None, None),
                          ("", "update", "Y", None, None)])
    assert [r.symbol for r in wl.apply_changes(ch).collect()] == ["AAA"]
    out = [r.outcome for r in wl.change_outcomes(ch).orderBy("event_id").collect()]
    assert out == ["invalid_symbol", "added", "invalid_symbol"]


def test_changes_without_symbol_or_time_keep_their_outcome(spark):
    rows = [(1, None, "AAA", "add"), (2, dt.datetime(2024, 1, 2), None, "deactivate"), (3, dt.datetime(2024, 1, 2), "  ", "add"),
            (4, dt.datetime(2024, 1, 2), "AAA", "deactivate"), (5, None, "", "reactivate"), (6, dt.datetime(2024, 1, 1), " aaa\t", "add")]
    ch = spark.createDataFrame([(i, t, s, o, None, None, None) for i, t, s, o in rows],
                               "event_id long, event_ts timestamp_ntz, symbol string, op string, company_name string, "
                               "category string, notes string")
    got = {r.event_id: (r.outcome, r.changed) for r in wl.change_outcomes(ch).collect()}
    assert got == {1: ("added", True), 2: ("invalid_symbol", False), 3: ("invalid_symbol", False), 4: ("deactivated", True),
                   5: ("invalid_symbol", False), 6: ("already_active", False)}
    assert got == {r.event_id: (r.outcome, r.changed) for r in wl.change_outcomes(ch, blocks=1).collect()}
    snap = wl.apply_changes(ch).collect()
    assert [(r.symbol, r.is_active, r.watchlist_id) for r in snap] == [("AAA", False, 1)]

"""Watchlist changes as DataFrame transforms: snapshot + ordered change log →
next snapshot, plus an outcome label per change and insert-if-absent.

Rules of the four operations (``op``):

* ``add``        – symbol upper-cased and stripped. Absent: insert, active,
                   attributes set ('' → NULL), created = updated = event time,
                   new id. Inactive: re-activate and overwrite the three
                   attributes, updated = event time (id and created kept).
                   Active: no change.
* ``deactivate`` – exact symbol. Active: inactive, updated = event time.
                   Otherwise no change.
* ``reactivate`` – exact symbol. Inactive: active, updated = event time,
                   attributes kept. Otherwise no change.
* ``update``     – exact symbol. Present (any status): overwrite the three
                   attributes ('' → NULL), updated = event time. Absent: nothing.

No per-row loop: a run of events acts on a symbol's state (absent, inactive,
active) as a pair – does it create the symbol, which status does it set last –
and pairs compose associatively: ``(a, s) then (b, t) = (a or b, t else s)``.
Snapshot rows enter as ``seed`` events that precede every change. The log, in
the order (symbol, phase, event_ts, event_id), is cut into blocks of consecutive
rows; each block is scanned on its own and the blocks' pairs are composed into
the state on entry (see ``classify_events``), so a symbol's log is spread over
as many tasks as it fills. From the state before it an event is *effective* or
not. The next snapshot is then a grouped aggregate (``max_by`` / ``min_by`` over
effective events), which Spark combines partially before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tickspan.functions import blank_to_null, normalize_symbol
from tickspan.schemas import WATCHLIST

OPS = ("add", "deactivate", "reactivate", "update")

# Outcome labels, one per (operation, prior state).
OUTCOMES = {
    ("add", "absent"): "added",
    ("add", "inactive"): "reactivated",
    ("add", "active"): "already_active",
    ("deactivate", "active"): "deactivated",
    ("deactivate", "inactive"): "already_inactive",
    ("reactivate", "inactive"): "reactivated",
    ("reactivate", "active"): "already_active",
    ("update", "active"): "updated",
    ("update", "inactive"): "updated",
}
NOT_FOUND = "not_found"
INVALID = "invalid_symbol"      # no symbol, or an empty one once stripped


def make_changes(spark, items, start=None) -> DataFrame:
    """A change log from ``(op, symbol, company_name, category, notes)``
    tuples, in order (one second apart from ``start``, default now) – the
    interactive add / deactivate / reactivate / update calls as data."""
    import datetime as dt
    t0 = start or dt.datetime.now().replace(microsecond=0)
    rows = []
    for i, it in enumerate(items):
        op, symbol, *attrs = it
        attrs = (list(attrs) + [None, None, None])[:3]
        if op not in OPS:
            raise ValueError(f"unknown operation {op!r}")
        rows.append((i, t0 + dt.timedelta(seconds=i), symbol, op, *attrs))
    from tickspan.schemas import WATCHLIST_CHANGES
    return spark.createDataFrame(rows, WATCHLIST_CHANGES)


def _event_stream(snapshot: DataFrame | None, changes: DataFrame) -> DataFrame:
    ch = changes.select(
        F.when(F.col("op") == "add", normalize_symbol("symbol")).otherwise(F.col("symbol")).alias("symbol"),
        F.lit(1).alias("_phase"), "event_ts", F.col("event_id").cast("bigint").alias("event_id"), "op",
        blank_to_null("company_name").alias("company_name"),
        blank_to_null("category").alias("category"),
        blank_to_null("notes").alias("notes"),
        F.lit(None).cast("boolean").alias("_seed_active"),
        F.lit(None).cast("timestamp_ntz").alias("_seed_created"),
        F.lit(None).cast("bigint").alias("_seed_id"),
    )
    if snapshot is None:
        return ch
    seeds = snapshot.select(
        "symbol", F.lit(0).alias("_phase"), F.col("updated_at").alias("event_ts"),
        F.lit(-1).cast("bigint").alias("event_id"), F.lit("seed").alias("op"),
        "company_name", "category", "notes",
        F.col("is_active").alias("_seed_active"), F.col("created_at").alias("_seed_created"),
        F.col("watchlist_id").alias("_seed_id"),
    )
    return seeds.unionByName(ch)


def _ordered_blocks(ev: DataFrame, blocks: int | None) -> DataFrame:
    """Events in blocks of consecutive rows of the total order (symbol, phase,
    event_ts, event_id, contents): ``_block`` and the position ``_at``.

    Blocks are range partitions of the whole key and a row number, so their size
    depends on neither symbols nor days, and equal rows are split as well. The
    blocks are checkpointed: the range bounds are sampled once, and a lost task
    later on cannot see others."""
    from tickspan.session import cut_lineage
    keys = ["symbol", "_phase", "event_ts", "event_id", "_tie", "_row"]
    ev = ev.withColumns({"_tie": F.xxhash64("op", "company_name", "category", "notes"), "_row": F.monotonically_increasing_id()})
    dealt = ev.repartitionByRange(blocks, *keys) if blocks else ev.repartitionByRange(*keys)
    dealt = dealt.sortWithinPartitions(*keys).drop("_row").withColumn("_at", F.monotonically_increasing_id())
    # The id numbers rows by partition: its high half is the partition.
    return cut_lineage(dealt.withColumn("_block", F.shiftright("_at", 33)))


def classify_events(snapshot: DataFrame | None, changes: DataFrame, blocks: int | None = None) -> DataFrame:
    """Every event with ``_exists_before``, ``_active_before`` (NULL when the
    symbol does not exist), ``_effective`` and ``_ord`` (its position).

    Each block of the ordered log composes the pair of every symbol in it (one
    partial aggregate); a symbol's pairs, one per block, are composed in order to
    the state on entry. Blocks hold consecutive rows, so only the first symbol of
    a block can have come before: at most one entry per block is joined back, by
    broadcast. ``blocks``: how many (default: as many as a shuffle makes).

    Events without a symbol (NULL or blank) change nothing and are never
    shuffled by it; events without a time come first; events that tie on time and
    id go by a hash of their contents.
    """
    ev = _event_stream(snapshot, changes)
    op = F.col("op")
    status = (F.when(op == "seed", F.col("_seed_active"))
              .when(op.isin("add", "reactivate"), F.lit(True))
              .when(op == "deactivate", F.lit(False)))
    # The add form refuses an empty symbol: such an event changes nothing.
    valid = F.coalesce(F.col("symbol") != F.lit(""), F.lit(False))
    ev = ev.withColumns({"_valid": valid, "_start": op.isin("seed", "add") & valid, "_sv": F.when(valid, status)})
    none = ev.where(~F.col("_valid")).withColumns({
        "_exists_at": F.lit(False), "_status": F.lit(None).cast("boolean"), "_exists_before": F.lit(False),
        "_active_before": F.lit(None).cast("boolean"), "_effective": F.lit(False)})
    ev = _ordered_blocks(ev.where(F.col("_valid")), blocks)

    # The pair of every (symbol, block), and what the symbol's earlier blocks compose to.
    pairs = ev.groupBy("symbol", "_block").agg(
        F.max("_start").alias("_creates"), F.max_by("_sv", F.when(F.col("_sv").isNotNull(), F.col("_at"))).alias("_sets"))
    earlier = Window.partitionBy("symbol").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    entry = pairs.select("symbol", "_block", F.max("_creates").over(earlier).alias("_x_in"),
                         F.last("_sets", ignorenulls=True).over(earlier).alias("_s_in")).where(F.col("_x_in").isNotNull())
    ev = ev.join(F.broadcast(entry), ["symbol", "_block"], "left")

    # Within a block the pair of the events before: it creates, or the symbol came in.
    before = Window.partitionBy("symbol", "_block").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    ev = ev.withColumns({
        "_exists_before": F.coalesce(F.col("_x_in"), F.lit(False)) | F.coalesce(F.max("_start").over(before), F.lit(False)),
        "_sets": F.coalesce(F.last("_sv", ignorenulls=True).over(before), F.col("_s_in"))})
    ev = ev.withColumns({"_active_before": F.when(F.col("_exists_before"), F.col("_sets")),
                         "_exists_at": F.col("_exists_before") | F.col("_start"),
                         "_ord": F.struct("_phase", "event_ts", "event_id", "_tie")})
    # Status changes of a symbol that does not exist yet are no-ops.
    ev = ev.withColumn("_status", F.when(F.col("_exists_at"), F.col("_sv")))
    eb, ab = F.col("_exists_before"), F.col("_active_before")
    effective = (F.when(op == "seed", F.lit(True))
                 .when(op == "add", ~eb | ~ab)
                 .when(op == "deactivate", eb & ab)
                 .when(op == "reactivate", eb & ~ab)
                 .when(op == "update", eb)
                 .otherwise(F.lit(False)))
    ev = ev.withColumn("_effective", effective).drop("_x_in", "_s_in", "_sets", "_block", "_at", "_tie")
    return ev.unionByName(none.withColumn("_ord", F.lit(None).cast(ev.schema["_ord"].dataType)))


def change_outcomes(changes: DataFrame, snapshot: DataFrame | None = None,
                    blocks: int | None = None) -> DataFrame:
    """One row per change: event_id, symbol (as matched), op, outcome.

    Outcomes: added, reactivated, already_active, deactivated,
    already_inactive, updated, not_found (a change to an absent symbol),
    invalid_symbol (a change whose symbol is NULL or blank)."""
    ev = classify_events(snapshot, changes, blocks).where(F.col("op") != "seed")
    prior = (F.when(~F.col("_exists_before"), F.lit("absent"))
             .when(F.col("_active_before"), F.lit("active")).otherwise(F.lit("inactive")))
    label = F.lit(NOT_FOUND)
    for (o, p), text in OUTCOMES.items():
        label = F.when((F.col("op") == o) & (prior == p), F.lit(text)).otherwise(label)
    label = F.when(~F.col("_valid"), F.lit(INVALID)).otherwise(label)
    return ev.select("event_id", "event_ts", "symbol", "op", label.alias("outcome"), "_effective") \
             .withColumnRenamed("_effective", "changed")


def apply_changes(changes: DataFrame, snapshot: DataFrame | None = None,
                  id_offset=None, blocks: int | None = None) -> DataFrame:
    """Next watchlist snapshot (``WATCHLIST`` layout).

    Symbols kept from ``snapshot`` keep their ids; new symbols get ids above
    the snapshot's maximum (or above ``id_offset``), numbered in symbol order
    (see ``assign_ids``)."""
    ev = classify_events(snapshot, changes, blocks)
    ordv = F.col("_ord")
    eff = F.col("_effective")
    carries = eff & F.col("op").isin("seed", "add", "update")
    g = ev.groupBy("symbol").agg(
        F.max(F.col("_exists_at").cast("int")).alias("_exists"),
        F.max_by("_status", F.when(F.col("_status").isNotNull(), ordv)).alias("is_active"),
        F.max_by(F.struct("company_name", "category", "notes"), F.when(carries, ordv)).alias("_attrs"),
        F.max_by("event_ts", F.when(eff, ordv)).alias("updated_at"),
        F.max("_seed_created").alias("_seed_created"),
        F.min_by("event_ts", F.when(F.col("op") == "add", ordv)).alias("_first_add"),
        F.max("_seed_id").alias("watchlist_id"),
    ).where(F.col("_exists") == 1)
    snap = g.select(
        "watchlist_id", "symbol",
        F.col("_attrs.company_name").alias("company_name"),
        F.col("_attrs.category").alias("category"),
        F.col("_attrs.notes").alias("notes"),
        "is_active",
        F.coalesce("_seed_created", "_first_add").alias("created_at"),
        "updated_at",
    )
    if id_offset is None:
        id_offset = (snapshot.select(F.coalesce(F.max("watchlist_id"), F.lit(0))).scalar()
                     if snapshot is not None else F.lit(0))
    # The fold runs once; numbering reads its result several times.
    from tickspan.session import cut_lineage
    return assign_ids(cut_lineage(snap), id_offset)


def assign_ids(df: DataFrame, offset, id_col: str = "watchlist_id", order_col: str = "symbol") -> DataFrame:
    """Fill NULL ids with ``offset + rank`` of the row among NULL-id rows in
    ``order_col`` order: dense, deterministic, independent of partitioning.

    The rank is distributed: rows are range-partitioned on ``order_col``
    (partitions hold consecutive key ranges) and numbered locally; partition
    offsets come from one row per partition. The numbered rows are
    checkpointed (reliably, in the shared checkpoint folder) before both the
    offsets and the final numbering read them, so range bounds sampled once
    serve both."""
    from tickspan.session import cut_lineage
    offset = F.lit(offset) if not hasattr(offset, "_jc") else offset
    new = df.where(F.col(id_col).isNull())
    kept = df.where(F.col(id_col).isNotNull())
    # Sorted range partitions: the position inside one is the low half of the
    # id that numbers rows by partition, so no second shuffle is needed.
    place = F.monotonically_increasing_id()
    ranged = cut_lineage(new.repartitionByRange(order_col).sortWithinPartitions(order_col)
                         .withColumn("_at", place)
                         .withColumn("_p", F.shiftright("_at", 33))
                         .withColumn("_i", F.col("_at").bitwiseAND((1 << 33) - 1) + 1).drop("_at"))
    sizes = ranged.groupBy("_p").agg(F.max("_i").alias("_n"))
    # One row per partition: a single-task window over at most
    # spark.sql.shuffle.partitions rows.
    sizes = sizes.withColumn("_base", F.coalesce(
        F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    numbered = ranged.join(F.broadcast(sizes.select("_p", "_base")), "_p").select(
        *[(offset + F.col("_base") + F.col("_i")).cast("bigint").alias(id_col) if c == id_col else F.col(c)
          for c in df.columns])
    return kept.unionByName(numbered).select(*WATCHLIST.fieldNames())


def insert_if_absent(current: DataFrame, candidates: DataFrame, load_ts=None) -> DataFrame:
    """Rows of ``candidates`` (symbol, company_name, category, notes) whose
    symbol is not in ``current`` (exact match; one row per symbol, the least
    attribute triple if a symbol repeats), as new watchlist rows with
    defaults: active, created = updated = ``load_ts``, ids above the current
    maximum. A hash anti-join; ``current`` is broadcast only if small."""
    from tickspan.operators.joins import join_small
    ts = F.lit(load_ts).cast("timestamp_ntz") if load_ts is not None else F.localtimestamp()
    cur = current.select("symbol")
    # One candidate per symbol, chosen deterministically.
    cands = (candidates.groupBy("symbol")
             .agg(F.min(F.struct("company_name", "category", "notes")).alias("_a"))
             .select("symbol", "_a.company_name", "_a.category", "_a.notes"))
    new = join_small(cands, cur, "symbol", "left_anti")
    rows = new.select(
        F.lit(None).cast("bigint").alias("watchlist_id"), "symbol", "company_name", "category", "notes",
        F.lit(True).alias("is_active"), ts.alias("created_at"), ts.alias("updated_at"))
    top = current.select(F.coalesce(F.max("watchlist_id"), F.lit(0))).scalar()
    return assign_ids(rows, top)

"""Sinks: append-only raw landing (S3) and layer materialization (S10–S12)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickspan.schemas import RAW_STOCK_PRICES
from tickspan.sources import versions
from tickspan.sources.landing import land


def schema_name(custom: str | None, target: str) -> str:
    """Layer routing: a model's custom schema, upper-cased, else the target."""
    return target if custom is None else custom.upper()


def append_raw(rows: DataFrame, path: str, batch: tuple[str, int] | None = None) -> None:
    """Append raw price rows (never updates). Overlap between fetches is
    expected: staging keeps the latest load per (ticker, date). With ``batch``
    (source, number) an append that is repeated lands once."""
    rows = rows.select(*RAW_STOCK_PRICES.fieldNames())
    if batch is None:
        rows.write.mode("append").parquet(path)
    else:
        land(rows, path, *batch)


# Default physical layout: the daily mart is read by period (a date range), so
# it is partitioned by year; facts and dimensions are left unpartitioned.
DEFAULT_PARTITIONING = {"mart_watchlist_performance": ["calendar_year"]}
FILES_PER_PARTITION = 64


def materialize(models, root: str | None = None, target_schema: str = "PUBLIC",
                names: list[str] | None = None, partition_by: dict | None = None,
                share_intermediates: bool = True, rebind: bool = False, versioned: bool = False, watch=None) -> dict:
    """Materialize the model graph layer by layer.

    Views are registered as temporary views ``<LAYER>__<model>``; tables are
    rebuilt in full (overwrite) as parquet under ``root/<LAYER>/<model>``, or
    as catalog tables ``<LAYER>.<model>`` when ``root`` is None. Returns
    {model: location}. Each write is one job; a lost executor only retries
    tasks. An overwrite deletes the old files first, so readers must wait for it;
    with ``versioned`` each layer's tables go to a new version below
    ``root/<LAYER>`` instead, which is published when all of the build is written
    (``versions.read(spark, root/<LAYER>, model)`` reads it), and a build that
    fails changes nothing.

    A partitioned table is dealt by its partition columns and a bucket of the
    ticker, so a year is written by ``FILES_PER_PARTITION`` tasks at most and
    not by every task.

    With ``share_intermediates`` dedup and the indicator pass are computed
    once and stored (as Parquet, in ``spark.checkpoint.dir``; the staged
    prices are a projection of the same table) before the tables that
    read them are written, instead of being recomputed for every fact and
    mart. With ``rebind`` each
    written table replaces the model's lazy definition, so later readers (the
    data-quality checks, say) read the table. ``watch`` (``quality.Watch``) counts
    violations while the tables are written."""
    from tickspan.plans.models import MODEL_LAYERS
    spark = models.spark
    if share_intermediates:
        models.share_intermediates()
    if versioned and root is None:
        raise ValueError("versions need a root folder")
    out, fresh = {}, {}
    for name in names or list(MODEL_LAYERS):
        layer, kind = MODEL_LAYERS[name]
        schema = schema_name(layer, target_schema)
        df = models.model(name)
        if kind == "view":
            view = f"{schema}__{name}"
            df.createOrReplaceTempView(view)
            out[name] = view
            continue
        parts = (DEFAULT_PARTITIONING if partition_by is None else partition_by).get(name)
        if parts:
            bucket = F.pmod(F.xxhash64("ticker_symbol"), F.lit(FILES_PER_PARTITION))
            df = df.repartition(*parts, bucket)
        if watch is not None:
            df = watch.attach(name, df)
        w = df.write.mode("overwrite")
        if parts:
            w = w.partitionBy(*parts)
        if root is not None:
            layer_dir = f"{root.rstrip('/')}/{schema}"
            if versioned:
                layer_dir = fresh.setdefault(schema, versions.new_version(layer_dir))
            loc = f"{layer_dir}/{name}"
            w.parquet(loc)
            written = spark.read.parquet(loc) if rebind else None
        else:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema}")
            loc = f"{schema}.{name}"
            w.format("parquet").saveAsTable(loc)
            written = spark.table(loc) if rebind else None
        if written is not None:
            models.__dict__[name] = written
        out[name] = loc
    for version in fresh.values():
        versions.publish(spark, version)
    return out


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists and holds data files, on whatever file system it
    names. A path that cannot be reached raises."""
    fs, p = versions.file_system(spark, path)
    if not fs.exists(p):
        return False
    files = fs.listFiles(p, True)
    while files.hasNext():
        if not files.next().getPath().getName().startswith(("_", ".")):
            return True
    return False


def fetch_bounded(df: DataFrame, max_rows: int):
    """A small final result as pandas, column names lower-cased (the client
    edge). The caller states how many rows it takes; more are refused, not
    truncated."""
    rows = df.limit(max_rows + 1).toPandas()
    if len(rows) > max_rows:
        raise ValueError(f"result has more than {max_rows} rows; write it to a table instead")
    rows.columns = [c.lower() for c in rows.columns]
    return rows


def fetch_chunks(df: DataFrame, rows: int = 10_000):
    """A result of any size for a client, as pandas frames of at most ``rows``
    rows with lower-cased columns, in the result's order. Tasks encode the chunks
    as Arrow; the client holds one partition's chunks at a time."""
    import pyarrow as pa

    def encode(batches):
        for b in batches:
            for at in range(0, b.num_rows, rows):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, b.schema) as w:
                    w.write_batch(b.slice(at, rows))
                yield pa.RecordBatch.from_pydict({"chunk": pa.array([sink.getvalue().to_pybytes()], pa.binary())})

    for row in df.mapInArrow(encode, "chunk binary").toLocalIterator():
        out = pa.ipc.open_stream(row["chunk"]).read_pandas()
        out.columns = [c.lower() for c in out.columns]
        yield out


def with_load_defaults(rows: DataFrame, loaded_at=None, source: str = "alpha_vantage") -> DataFrame:
    """Fill the raw table's load-time defaults: ``source`` and ``loaded_at``
    (a parameter, so that a re-run stamps the same time; the session's
    current time only when none is given). Existing non-NULL values are kept."""
    ts = F.lit(loaded_at).cast("timestamp_ntz") if loaded_at is not None else F.localtimestamp()
    cols = rows.columns
    src = F.coalesce(F.col("source"), F.lit(source)) if "source" in cols else F.lit(source)
    at = F.coalesce(F.col("loaded_at").cast("timestamp_ntz"), ts) if "loaded_at" in cols else ts
    return rows.withColumns({"source": src, "loaded_at": at}).select(*RAW_STOCK_PRICES.fieldNames())

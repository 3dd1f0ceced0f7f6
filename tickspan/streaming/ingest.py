"""Incremental landing: new API documents in a folder → raw price table.

Each run picks up only documents not seen before (file-source bookkeeping in
the checkpoint), flattens them and appends rows to the raw table; rejects go to
their own table. Batches land as plain parquet files, like those of
``sinks.append_raw``, so both writers' rows are read together (a streaming file
sink would hide the other's). A batch that is repeated after a failure replaces
itself (``sources.landing``), in prices and rejects alike. With ``availableNow`` the run processes everything pending
and stops, which is the batch loop of the ingestion script without re-reading
old files.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import SparkSession

from tickspan.sources.api_json import flatten_series, parse_lines, rejects
from tickspan.sources.landing import land, stream_id


def _checkpoint(spark: SparkSession, given: str | None, name: str, target: str) -> str:
    """The folder of one query's bookkeeping: it must outlive the session and
    is named by the table written, so two tables never share one."""
    base = given or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise ValueError("no checkpoint location: pass one or set spark.checkpoint.dir")
    return f"{base.rstrip('/')}/{name}-{hashlib.sha256(target.rstrip('/').encode()).hexdigest()[:16]}"


def ingest_landed(spark: SparkSession, landed_dir: str, raw_dir: str, rejects_dir: str,
                  checkpoint: str | None = None, max_files_per_trigger: int | None = None,
                  available_now: bool = True):
    """Start the two streaming queries (rows, rejects); return them."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    docs = parse_lines(reader.text(landed_dir))

    def start(df, path, name):
        books = _checkpoint(spark, checkpoint, name, path)
        stream = stream_id(spark, books)

        def put(batch, batch_id):
            land(batch, path, stream, batch_id)
        w = df.writeStream.foreachBatch(put).option("checkpointLocation", books)
        w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
        return w.start()

    return (start(flatten_series(docs), raw_dir, "raw_prices"),
            start(rejects(docs), rejects_dir, "raw_rejects"))


def run_once(spark: SparkSession, landed_dir: str, raw_dir: str, rejects_dir: str,
             checkpoint: str | None = None) -> None:
    """Process every pending document and wait until both queries finish."""
    for q in ingest_landed(spark, landed_dir, raw_dir, rejects_dir, checkpoint):
        q.awaitTermination()

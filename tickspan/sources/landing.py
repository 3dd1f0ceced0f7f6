"""Idempotent landing: a batch is in the table once, however often it is written.

The files of a batch carry its stream and number in their names. A batch is
written aside, files that an unfinished attempt left under its names are removed,
the new ones are renamed into the table, and a manifest entry keyed by stream and
batch closes it. A batch found in the manifest is not written again; one that
failed before that replaces itself. Staged files and the manifest lie in folders
that Spark's readers skip, so the table stays plain Parquet next to rows that
others append.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tickspan.sources.versions import exists, file_system, write_file

MANIFEST, STAGED = "_batches", "_staged"


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """Identity of a stream's bookkeeping: made with the checkpoint folder and
    kept there, so numbers of another stream (or of a fresh start) are not taken
    for the same batches."""
    path = f"{checkpoint.rstrip('/')}/landing-id"
    if not exists(spark, path):
        write_file(spark, path, uuid.uuid4().hex[:16])
    return spark.read.text(path).first()[0].strip()


def landed(spark: SparkSession, path: str, stream: str, batch_id: int) -> bool:
    return exists(spark, f"{path.rstrip('/')}/{MANIFEST}/{stream}-{batch_id}")


def land(batch: DataFrame, path: str, stream: str, batch_id: int) -> bool:
    """Put one batch into the Parquet table at ``path``; False if it is there already."""
    spark, path = batch.sparkSession, path.rstrip("/")
    if landed(spark, path, stream, batch_id):
        return False
    prefix = f"batch-{stream}-{batch_id}-"
    aside = f"{path}/{STAGED}/{prefix}{uuid.uuid4().hex}"
    batch.write.parquet(aside)
    fs, folder = file_system(spark, path)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for old in fs.listStatus(folder):
        if old.getPath().getName().startswith(prefix):
            fs.delete(old.getPath(), False)
    parts = sorted(s.getPath().getName() for s in fs.listStatus(hadoop(aside)) if s.getPath().getName().startswith("part-"))
    names = [f"{prefix}{i:05d}.parquet" for i in range(len(parts))]
    for part, name in zip(parts, names):
        if not fs.rename(hadoop(f"{aside}/{part}"), hadoop(f"{path}/{name}")):
            raise OSError(f"could not move {part} of batch {batch_id} into {path}")
    write_file(spark, f"{path}/{MANIFEST}/{stream}-{batch_id}", "\n".join(names))
    fs.delete(hadoop(aside), True)
    return True

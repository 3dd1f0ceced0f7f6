"""Versioned folders: a rebuild never touches what readers have open.

A layer holds one folder per version (``v-<id>``) and a file ``CURRENT`` that
names the published one. A build writes all of a layer's tables into a new
version and then replaces ``CURRENT`` by one atomic rename, so a reader sees the
old tables or the new ones, never a mixture, and a build that fails leaves the old
version published. A reader resolves the version once and reads that folder.
Versions are removed only by ``prune``. (An object store without atomic rename
needs a file system that offers it, or a catalog table.)
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

POINTER = "CURRENT"


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of ``path`` and the path as Hadoop's."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def write_file(spark: SparkSession, path: str, text: str) -> None:
    """A small file, put in place of any other by one rename."""
    jvm = spark.sparkContext._jvm
    new = f"{path}.{uuid.uuid4().hex}"
    fs, p = file_system(spark, new)
    out = fs.create(p, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
    options[0] = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(p), fs.makeQualified(jvm.org.apache.hadoop.fs.Path(path)), options)


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return fs.exists(p)


def new_version(layer: str) -> str:
    """The folder of a version to be written."""
    return f"{layer.rstrip('/')}/v-{uuid.uuid4().hex}"


def publish(spark: SparkSession, version: str) -> None:
    """Make a completely written version the layer's current one."""
    layer, name = version.rstrip("/").rsplit("/", 1)
    if not exists(spark, version):
        raise FileNotFoundError(f"no version at {version}")
    write_file(spark, f"{layer}/{POINTER}", name)


def is_versioned(spark: SparkSession, layer: str) -> bool:
    return exists(spark, f"{layer.rstrip('/')}/{POINTER}")


def current(spark: SparkSession, layer: str) -> str:
    """The folder of the published version, as of now."""
    layer = layer.rstrip("/")
    if not is_versioned(spark, layer):
        raise FileNotFoundError(f"no published version at {layer}")
    return f"{layer}/{spark.read.text(f'{layer}/{POINTER}').first()[0].strip()}"


def read(spark: SparkSession, layer: str, table: str | None = None) -> DataFrame:
    """A table of the published version (or the layer, where it is one table)."""
    path = current(spark, layer)
    return spark.read.parquet(f"{path}/{table}" if table else path)


def replace_table(df: DataFrame, layer: str) -> str:
    """Write ``df`` as the next version of a one-table layer; it may read the
    current one. A plain Parquet folder becomes a layer: its files go once the
    version is published, so that nobody reads them as the current rows."""
    spark = df.sparkSession
    path = new_version(layer)
    df.write.parquet(path)
    publish(spark, path)
    fs, p = file_system(spark, layer)
    for f in fs.listStatus(p):
        if f.isFile() and f.getPath().getName() != POINTER:
            fs.delete(f.getPath(), False)
    return path


def versions(spark: SparkSession, layer: str) -> list[str]:
    """Names of all versions, the oldest first."""
    fs, p = file_system(spark, layer.rstrip("/"))
    found = [s for s in fs.listStatus(p) if s.isDirectory() and s.getPath().getName().startswith("v-")]
    return [s.getPath().getName() for s in sorted(found, key=lambda s: (s.getModificationTime(), s.getPath().getName()))]


def prune(spark: SparkSession, layer: str, keep: int = 2) -> list[str]:
    """Remove all but the published version and the ``keep - 1`` latest others;
    returns what was removed. Readers of removed versions fail, so ``keep`` must
    cover the longest reader."""
    layer = layer.rstrip("/")
    live = current(spark, layer).rsplit("/", 1)[1]
    others = [v for v in versions(spark, layer) if v != live]
    gone = others[:max(0, len(others) - (keep - 1))]
    for v in gone:
        fs, p = file_system(spark, f"{layer}/{v}")
        fs.delete(p, True)
    return gone

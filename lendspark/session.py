"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Hot keys are split at run time by AQE; the force flag lets it do so even where a later operator
# then needs one more exchange. Timestamps are compared and printed in UTC everywhere.
SQL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Rows are widened after their shuffle (products, JSON, hashes), so small partitions still pay.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128KB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Files named one by one, as each batch of a file stream does, are otherwise listed by one task per file.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "32",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time SQL settings this library relies on to an existing session."""
    for key, value in SQL_DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """SQL settings that hold inside the block."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster, or a temporary one when Spark runs on one machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    context = spark.sparkContext  # remembers the folder: the setting itself is fixed once Spark runs
    if not hasattr(context, "_lendspark_shared"):
        context._lendspark_shared = tempfile.mkdtemp(prefix="lendspark-")
    return context._lendspark_shared


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/lendspark/{name}-{uuid.uuid4().hex}"


_kept: list[list[tuple[str, str | None]]] = []  # what was stored (path, table), per open `scratch` block


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is stored with `cut` or named by `discard_later` inside the block is deleted at its end; nothing may read it then."""
    _kept.append([])
    try:
        yield
    finally:
        for path, table in _kept.pop():
            if table:
                spark.sql(f"DROP TABLE IF EXISTS {table}")
            remove(spark, path)


def discard_later(path: str, table: str | None = None) -> None:
    """Delete what is stored at `path`, and the catalog's `table` over it, at the end of the open `scratch` block, if any."""
    if _kept:
        _kept[-1].append((path, table))


def _located(spark: SparkSession, path: str) -> tuple:
    """The path as the JVM knows it, and its file system."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    """Delete a stored table, wherever its file system is."""
    where, files = _located(spark, path)
    files.delete(where, True)


def exists(spark: SparkSession, path: str) -> bool:
    where, files = _located(spark, path)
    return files.exists(where)


def store_file(spark: SparkSession, folder: str, name: str, content: bytes) -> None:
    """Write a small file from the driver; readers of the folder see it whole or not at all."""
    hidden, files = _located(spark, f"{folder}/_{name}")
    out = files.create(hidden, True)
    out.write(bytearray(content))
    out.close()
    shown, _ = _located(spark, f"{folder}/{name}")
    if not files.rename(hidden, shown):
        raise OSError(f"{shown} cannot be written")


def local_folder(spark: SparkSession, path: str) -> str | None:
    """The folder as plain code names it, if it is in a file system that all tasks have mounted; else nothing."""
    where, files = _located(spark, path)
    return files.makeQualified(where).toUri().getPath() if files.getUri().getScheme() == "file" else None


def cut(df: DataFrame) -> DataFrame:
    """Compute `df` once, store it in the shared folder and go on from the stored table.

    A table rather than an RDD checkpoint: that would run the last stage twice, and leave later steps
    without column pruning and without a size to plan by.
    """
    path = scratch_path(df.sparkSession, "cut")
    discard_later(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Not needed where it is installed on every node; the archive travels with the application's files.
    """
    context = spark.sparkContext
    if getattr(context, "_lendspark_shipped", False):
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="lendspark-")) / "lendspark.zip"
    with zipfile.ZipFile(archive, "w") as bundle:
        for source in sorted(root.rglob("*.py")):
            bundle.write(source, source.relative_to(root.parent))
    context.addPyFile(str(archive))
    context._lendspark_shipped = True

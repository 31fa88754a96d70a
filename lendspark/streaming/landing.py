"""Incremental landing: a stream over the landing zone that reads every delivered file once.

The batch landing of `operators.bronze` opens and hashes all files on every run. Here a file stream keeps its own
log of the files it has seen, so that a run over n old and k new files lists names and reads k. The trigger
takes what is there and ends; nothing waits for further files.

A batch can be repeated: which files belong to it is fixed in the stream's log before it starts, when it was
received and by which run is fixed in a claim stored beside that log, and its rows go to partitions of its own, which a
repeat writes over. So a batch that was stored in part, even before midnight and repeated after it, leaves
no doubles and keeps its day.

Deliveries are known by their path: a file that is changed in place after it was read is not read again, unlike in the
batch landing. However old a file says it is, it is read; the log keeps about a hundred bytes for each.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime, timezone
from functools import cache, partial, reduce
from operator import or_

import pyarrow as pa
from pyarrow import parquet
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendspark import schemas
from lendspark.config import RECORD_GLOB, SOURCE_FORMATS, SOURCE_GLOBS, WHOLE_BYTES
from lendspark.operators.bronze import RECORD_SOURCES, envelope_columns, record_columns
from lendspark.session import exists, local_folder, settings, store_file
from lendspark.sources.files import BINARY_FILES, read_table

FILES_PER_BATCH = 100_000
BATCH = "landing_batch"

_CLAIM = "run_id string, received_at timestamp"
_NEVER_TOO_OLD = "36500d"

# Opening a file costs little beside a task, and each task of a batch stores a file per source: small files are dealt to one task a core.
_BATCH_CONF = {"spark.sql.files.openCostInBytes": "64KB"}
_LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
# Where files are mounted, the driver looks up a thousand sooner than a job does, and a log written by the older of Spark's two interfaces
# to file systems takes no processes of its own to read links. There, neither interface renames more safely than the other.
_MOUNTED_CONF = {
    "spark.sql.sources.parallelPartitionDiscovery.threshold": "1000",
    "spark.sql.streaming.checkpointFileManagerClass": "org.apache.spark.sql.execution.streaming.checkpointing.FileSystemBasedCheckpointFileManager",
}


def _claim(spark: SparkSession, path: str, run_id: str, received_at: datetime) -> tuple[str, datetime]:
    """Run and time of a batch: those of its first attempt, whoever repeats it."""
    held = read_table(spark, path, _CLAIM).head() if exists(spark, path) else None
    if held is None:
        claim = pa.table({"run_id": [run_id], "received_at": pa.array([received_at.astimezone(timezone.utc)], pa.timestamp("us", "UTC"))})
        sink = pa.BufferOutputStream()
        parquet.write_table(claim, sink)
        store_file(spark, path, "claim.parquet", sink.getvalue().to_pybytes())  # by the driver: a batch has no job of its own for it
        return run_id, received_at
    return held["run_id"], held["received_at"].astimezone(timezone.utc)


def _named_like(pattern: str) -> Column:
    """Whether the file's name ends as a pattern like `*.xml` says."""
    return F.endswith(F.element_at(F.split("path", "/"), -1), F.lit(pattern.removeprefix("*")))


def _drain(
    stream: DataFrame, log: str, store: str, run_id: str, received_at: datetime, rows_of: Callable[[DataFrame, str, datetime, Column], DataFrame]
) -> None:
    """Land everything that the stream has not seen yet, batch by batch."""

    def land_batch(batch: DataFrame, number: int) -> None:
        claimed = _claim(batch.sparkSession, f"{log}/claims/{number}", run_id, received_at)
        # As text, which names the same partition: a number would be written into the batch's code, to be compiled for each anew.
        rows = rows_of(batch, *claimed, F.lit(str(number)).alias(BATCH))
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("source", "ingest_date", BATCH).parquet(store)

    query = stream.writeStream.foreachBatch(land_batch).option("checkpointLocation", f"{log}/stream").trigger(availableNow=True)
    spark = stream.sparkSession
    listing = min(int(spark.conf.get(_LISTING_TASKS)), spark.sparkContext.defaultParallelism)
    mounted = _MOUNTED_CONF if local_folder(spark, log) else {}
    with settings(spark, _BATCH_CONF | mounted | {_LISTING_TASKS: str(listing)}):
        query.start().awaitTermination()


def _reader(spark: SparkSession, file_format: str, pattern: str, files_per_batch: int, archive: str | None):
    reader = (
        spark.readStream.format(file_format)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("maxFileAge", _NEVER_TOO_OLD)
    )
    return reader if archive is None else reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)


def land_files(
    spark: SparkSession,
    landing: str,
    store: str,
    run_id: str,
    received_at: datetime,
    *,
    patterns: Mapping[str, str] = SOURCE_GLOBS,
    files_per_batch: int = FILES_PER_BATCH,
    archive: str | None = None,
) -> DataFrame:
    """Land the files below `landing/<source>/` that were not landed before; returns all rows of `store`.

    Stored below `store`: `rows` and the stream's `log`. `patterns` names the files of each source. With `archive`, files are
    moved there once a later batch has begun, so that the listing stays short. A landing zone that does not exist is empty.
    JSON arrays above WHOLE_BYTES are left to `bronze.land_arrays`.
    """
    endings = "{" + ",".join(sorted({p.removeprefix("*") for p in patterns.values()})) + "}"
    files = _reader(spark, "binaryFile", f"*{endings}", files_per_batch, archive).schema(BINARY_FILES).load(f"{landing}/*")
    folder = F.element_at(F.split("path", "/"), -2)
    formats = F.create_map(*[F.lit(x) for source in patterns for x in (source, SOURCE_FORMATS[source])])
    wanted = reduce(or_, [(folder == source) & _named_like(pattern) for source, pattern in patterns.items()])
    whole = (formats[folder] != "json") | (F.col("length") <= WHOLE_BYTES)
    taken = wanted & whole & F.col("content").isNotNull()
    columns = cache(partial(envelope_columns, folder, formats[folder]))  # hundreds of calls to the JVM

    def rows(batch: DataFrame, run: str, received: datetime, number: Column) -> DataFrame:
        return batch.where(taken).select(*columns(run, received), number)

    _drain(files, f"{store}/log", f"{store}/rows", run_id, received_at, rows)
    return read_landed(spark, store)


def read_landed(spark: SparkSession, store: str) -> DataFrame:
    return read_table(spark, f"{store}/rows", f"{schemas.BRONZE}, {BATCH} long")


def land_lines(
    spark: SparkSession, landing: str, store: str, run_id: str, received_at: datetime, *, files_per_batch: int = FILES_PER_BATCH, archive: str | None = None
) -> DataFrame:
    """Land the line-delimited feeds that were not landed before, record by record; returns all rows of `store`."""
    lines = _reader(spark, "text", RECORD_GLOB, files_per_batch, archive).schema("value string").load(f"{landing}/*")
    meta = F.col("_metadata")
    found = lines.select(
        F.col("value").alias("line"), meta["file_path"].alias("path"), meta["file_name"].alias("name"), meta["file_size"].alias("size"),
        meta["file_modification_time"].alias("modified"), meta["file_block_start"].alias("block"),
    )
    folder = F.element_at(F.split("path", "/"), -2)

    def rows(batch: DataFrame, run: str, received: datetime, number: Column) -> DataFrame:
        numbered = batch.withColumn("position", F.struct("block", F.monotonically_increasing_id().alias("row")))
        named = numbered.where(folder.isin(*RECORD_SOURCES) & (F.trim("line") != "")).withColumn("source", folder)
        return named.select(*record_columns(F.col("source"), run, received), number)

    _drain(found, f"{store}/log", f"{store}/rows", run_id, received_at, rows)
    return read_landed_lines(spark, store)


def read_landed_lines(spark: SparkSession, store: str) -> DataFrame:
    return read_table(spark, f"{store}/rows", f"{schemas.BRONZE_RECORDS}, {BATCH} long")

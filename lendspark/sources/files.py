"""Landing files and stored tables. A folder or table that does not exist yet reads as empty."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendspark.config import RECORD_GLOB, SOURCE_FORMATS, SOURCE_GLOBS, WHOLE_BYTES
from lendspark.session import local_folder

BINARY_FILES = "path string, modificationTime timestamp, length bigint, content binary"


def _missing(error: AnalysisException) -> bool:
    return (error.getCondition() or "").startswith("PATH_NOT_FOUND")


def scan_landing(spark: SparkSession, landing: str, source: str) -> DataFrame:
    """The landed files of one source as (path, modificationTime, length, content).

    One row holds one file. JSON arrays above WHOLE_BYTES are left to `json_arrays.scan_array_elements`, any other
    file must stay below 2 GB.
    """
    reader = spark.read.format("binaryFile").option("pathGlobFilter", SOURCE_GLOBS[source])
    try:
        files = reader.load(f"{landing}/{source}")
        return files.where(F.col("length") <= WHOLE_BYTES) if SOURCE_FORMATS[source] == "json" else files
    except AnalysisException as error:
        if _missing(error):
            return spark.createDataFrame([], BINARY_FILES)
        raise


def large_arrays(spark: SparkSession, landing: str, source: str, larger_than: int = WHOLE_BYTES) -> DataFrame:
    """(name, size, modified) of the JSON arrays that `scan_landing` leaves out; nothing of them is read."""
    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", SOURCE_GLOBS[source]).load(f"{landing}/{source}")
    except AnalysisException as error:
        if not _missing(error):
            raise
        files = spark.createDataFrame([], BINARY_FILES)
    name = F.element_at(F.split("path", "/"), -1).alias("name")
    return files.where(F.col("length") > larger_than).select(name, F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def scan_lines(spark: SparkSession, landing: str, source: str) -> DataFrame:
    """The lines of a source's line-delimited feeds: (line, name, size, modified, position). Large files are split."""
    meta = F.col("_metadata")
    try:
        text = spark.read.option("pathGlobFilter", RECORD_GLOB).text(f"{landing}/{source}")
    except AnalysisException as error:
        if not _missing(error):
            raise
        return spark.createDataFrame([], "line string, name string, size bigint, modified timestamp, position struct<block:bigint,row:bigint>")
    return text.select(
        F.col("value").alias("line"),
        meta["file_name"].alias("name"),
        meta["file_size"].alias("size"),
        meta["file_modification_time"].alias("modified"),
        F.struct(meta["file_block_start"].alias("block"), F.monotonically_increasing_id().alias("row")).alias("position"),
    )


def scan_json_records(spark: SparkSession, path: str, item_schema: str, lines: bool = True) -> DataFrame:
    """Records of JSON files read straight from storage, with their origin.

    `lines=True` reads one object per line and splits large files; `lines=False` streams the items
    of one JSON array per file. Row numbers rise within a split, and splits are told apart by their
    offset, so (raw_path, position) is the order of arrival.
    """
    reader = spark.read.schema(item_schema).option("multiLine", not lines)
    meta = F.col("_metadata")
    return reader.json(path).select(
        F.struct(F.expr("*")).alias("item"),
        meta["file_path"].alias("raw_path"),
        F.struct(
            meta["file_block_start"].alias("block"), F.monotonically_increasing_id().alias("row")
        ).alias("position"),
    )


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A stored Parquet table under its declared schema."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if _missing(error):
            return spark.createDataFrame([], schema)
        raise


def write_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), mode: str = "overwrite") -> DataFrame:
    """Store a table as Parquet and return it as read back, so that later steps start from storage."""
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _write_each(prefix: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One file per text. A task that is repeated writes the same names over, and a name stands for a whole file."""
    task, n = TaskContext.get(), 0
    hidden = f"{prefix}-{task.partitionId():05d}-{task.taskAttemptId()}.part"
    for batch in batches:
        for text in batch.column(0).to_pylist():
            with open(hidden, "w", encoding="utf-8", newline="") as file:
                file.write(f"{text or ''}\n")
            os.replace(hidden, f"{prefix}-{task.partitionId():05d}-{n:09d}.txt")
            n += 1
    yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["files"])


def write_each(texts: DataFrame, folder: str) -> None:
    """Add every text (one column) to the folder as a text file of its own.

    For a file in a local file system Spark's writer starts several processes, which set its mode; there, tasks write files themselves.
    """
    mounted = local_folder(texts.sparkSession, folder)
    if mounted is None:
        texts.write.mode("append").option("maxRecordsPerFile", 1).text(folder)
        return
    os.makedirs(mounted, exist_ok=True)
    write = partial(_write_each, f"{mounted}/{uuid.uuid4().hex}")
    texts.mapInArrow(write, "files bigint").write.format("noop").mode("overwrite").save()

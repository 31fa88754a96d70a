"""Raw zone: every landed file with its content hash and provenance, stored once."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendspark import schemas
from lendspark.config import AML, FRAUD, SOURCE_FORMATS, SOURCE_GLOBS, SOURCES, WHOLE_BYTES
from lendspark.operators.skew import small
from lendspark.sources.files import large_arrays, read_table, scan_landing, scan_lines
from lendspark.sources.json_arrays import scan_array_elements

# Sources that may come with one record per line.
RECORD_SOURCES = (FRAUD, AML)

# What makes a landed file the same file: equal bytes under the same name on the same day.
_IDENTITY = ["source", "ingest_date", "raw_path"]


def envelope_columns(source: Column, payload_format: Column, run_id: str, received_at: datetime) -> list[Column]:
    """The columns of a landed file (path, content)."""
    name = F.element_at(F.split("path", "/"), -1)
    digest = F.sha2("content", 256)
    day = F.lit(received_at.date().isoformat())
    stored_as = F.concat(F.lit("bronze/"), source, F.lit("/ingest_date="), day, F.lit("/"), F.substring(digest, 1, 16), F.lit("_"), name)
    return [
        F.regexp_replace(name, r"(?<=.)\.[^.]*$", "").alias("source_event_id"),
        F.lit(run_id).alias("ingest_run_id"),
        F.lit(received_at).cast("timestamp").alias("received_at"),
        digest.alias("content_sha256"),
        stored_as.alias("raw_path"),
        payload_format.alias("payload_format"),
        F.col("content"),
        source.alias("source"),
        day.alias("ingest_date"),
    ]


def envelopes(files: DataFrame, source: str, run_id: str, received_at: datetime) -> DataFrame:
    """Provenance columns beside the raw content of `files` (path, content)."""
    columns = envelope_columns(F.lit(source), F.lit(SOURCE_FORMATS[source]), run_id, received_at)
    return files.where(F.col("content").isNotNull()).select(*columns)


def read_bronze(spark: SparkSession, bronze: str) -> DataFrame:
    return read_table(spark, bronze, schemas.BRONZE)


def stored_on(spark: SparkSession, bronze: str, ingest_date: str) -> DataFrame:
    """The rows landed on one day; only that day's partitions are read."""
    return read_bronze(spark, bronze).where(F.col("ingest_date") == ingest_date)


def append_new(batch: DataFrame, bronze: str, ingest_date: str) -> DataFrame:
    """Store the rows of a day's `batch` that are not stored yet and return the day's stored rows.

    Landing the same files again adds nothing. The first batch of a day goes straight to storage;
    later ones are checked against the identity columns of that day, so stored content is never read.
    """
    known = stored_on(batch.sparkSession, bronze, ingest_date).select(*_IDENTITY)
    fresh = batch if known.isEmpty() else batch.join(known, _IDENTITY, "left_anti")
    fresh.write.mode("append").partitionBy("source", "ingest_date").parquet(bronze)
    return stored_on(batch.sparkSession, bronze, ingest_date)


def land(spark: SparkSession, landing: str, bronze: str, run_id: str, received_at: datetime) -> DataFrame:
    """Land every source folder below `landing` and return what is stored for that day."""
    batch = None
    for source in SOURCES:
        rows = envelopes(scan_landing(spark, landing, source), source, run_id, received_at)
        batch = rows if batch is None else batch.unionByName(rows)
    return append_new(batch, bronze, received_at.date().isoformat())


def _delivered_as(source: Column, day: str) -> Column:
    """The name a delivery (name, size, modified) is stored under."""
    delivery = F.concat_ws("_", F.col("size").cast("string"), F.unix_micros("modified").cast("string"), F.col("name"))
    return F.concat(F.lit("bronze/"), source, F.lit(f"/ingest_date={day}/"), delivery)


def record_columns(source: Column, run_id: str, received_at: datetime) -> list[Column]:
    """The columns of a landed line (line, name, size, modified, position)."""
    day = received_at.date().isoformat()
    return [
        F.lit(run_id).alias("ingest_run_id"),
        F.lit(received_at).cast("timestamp").alias("received_at"),
        F.sha2("line", 256).alias("content_sha256"),
        _delivered_as(source, day).alias("raw_path"),
        F.col("position"),
        F.col("line"),
        source.alias("source"),
        F.lit(day).alias("ingest_date"),
    ]


def land_records(spark: SparkSession, landing: str, store: str, run_id: str, received_at: datetime) -> None:
    """Land the line-delimited feeds, record by record, each with the hash of its content.

    A delivery is known by its name, size and time of change: landing it again on the same day adds nothing.
    """
    day = received_at.date().isoformat()
    known = read_records(spark, store).where(F.col("ingest_date") == day).select("source", "raw_path").distinct()
    batch = None
    for source in RECORD_SOURCES:
        lines = scan_lines(spark, landing, source).where(F.trim("line") != "")
        rows = lines.select(*record_columns(F.lit(source), run_id, received_at))
        batch = rows if batch is None else batch.unionByName(rows)
    fresh = batch.join(small(known), ["source", "raw_path"], "left_anti")
    fresh.write.mode("append").partitionBy("source", "ingest_date").parquet(store)


def land_arrays(
    spark: SparkSession, landing: str, store: str, run_id: str, received_at: datetime, larger_than: int = WHOLE_BYTES
) -> None:
    """Land JSON arrays of more than `larger_than` bytes element by element, as `land_records` does with lines.

    A delivery that was landed before on the same day adds nothing; if all were, no file is opened.
    """
    day = received_at.date().isoformat()
    for source in RECORD_SOURCES:
        stored_as = _delivered_as(F.lit(source), day)
        known = read_records(spark, store).where((F.col("ingest_date") == day) & (F.col("source") == source)).select("raw_path").distinct()
        delivered = large_arrays(spark, landing, source, larger_than).select(stored_as.alias("raw_path"))
        if delivered.join(small(known), "raw_path", "left_anti").isEmpty():
            continue
        elements = scan_array_elements(spark, f"{landing}/{source}", SOURCE_GLOBS[source], larger_than)
        rows = elements.select(*record_columns(F.lit(source), run_id, received_at))
        fresh = rows.join(small(known), "raw_path", "left_anti")
        fresh.select(*rows.columns).write.mode("append").partitionBy("source", "ingest_date").parquet(store)


def read_records(spark: SparkSession, store: str) -> DataFrame:
    return read_table(spark, store, schemas.BRONZE_RECORDS)


def summary(rows: DataFrame) -> DataFrame:
    """Landed files and distinct contents of each source."""
    return rows.groupBy("source").agg(
        F.count(F.lit(1)).alias("files_landed"), F.countDistinct("content_sha256").alias("unique_hashes")
    )

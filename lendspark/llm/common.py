"""Helpers shared by the operators of this subpackage.

Words, blanks and lower-casing are ASCII rules on purpose: blanks are U+0020 and U+0009 to U+000D, and
only A to Z are lower-cased, so that every engine and every Unicode version gives the same words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import wraps

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendspark.session import configure, cut, scratch_path, ship_package

__all__ = ["BLANKS", "WORD", "configure", "cut", "documents", "lean", "prepare", "scratch_path", "split_row", "table", "text_of"]

BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

# Arrow batches are bounded by bytes, so that a batch of very long texts stays small in a Python worker.
BATCH_BYTES = 4 << 20


def lean(function: Callable) -> Callable:
    """When a task ends, hand back what Arrow keeps for later: workers live on and share an executor's memory."""

    @wraps(function)
    def run(*args) -> Iterator:
        yield from function(*args)
        pa.default_memory_pool().release_unused()

    return run


def prepare(spark: SparkSession) -> SparkSession:
    """Settings the operators rely on; the package is sent to the Python workers once."""
    configure(spark)
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def text_of(column: str) -> Column:
    """The text, a null one being empty."""
    return F.coalesce(F.col(column), F.lit(""))


def split_row(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The whole row in `_doc`, beside a name of the row and the given columns under names that cannot clash.

    Rows of stored files are named by their file and place in it, which a second read repeats; the rows of
    any other table are numbered and stored.
    """
    fields = [F.struct("*").alias("_doc"), *[F.col(name).alias(f"_{i}") for i, name in enumerate(names)]]
    place = F.concat_ws(":", F.hex(F.xxhash64("_metadata.file_path")), "_metadata.row_index")
    try:
        return df.select(place.alias("_row"), *fields)
    except AnalysisException as error:
        if not (error.getCondition() or "").startswith("UNRESOLVED_COLUMN"):
            raise
    numbered = cut(df.select(F.monotonically_increasing_id().cast("string").alias("_row"), fields[0]))
    inner = [F.col("_doc").getField(name).alias(f"_{i}") for i, name in enumerate(names)]
    return numbered.select("_row", "_doc", *inner)

"""One row per key, by order of arrival.

The rank filter lets Spark keep a single row per key in every map task before it shuffles, so a key
that holds a third of all rows costs one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ARRIVAL = ("raw_path", "position")


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    usable = df
    for key in keys:
        usable = usable.where(F.coalesce(F.col(key), F.lit("")) != "")
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return usable.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def latest_per_key(df: DataFrame, *keys: str) -> DataFrame:
    """The last row to arrive for each key; rows without a key are dropped."""
    return _pick(df, keys, [F.col(c).desc() for c in ARRIVAL])


def first_per_key(df: DataFrame, *keys: str) -> DataFrame:
    """The first row to arrive for each key; rows without a key are dropped."""
    return _pick(df, keys, [F.col(c).asc() for c in ARRIVAL])

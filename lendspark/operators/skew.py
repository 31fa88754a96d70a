"""Joins with small tables, and lookups that stay balanced when a few keys hold most of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendspark.session import cut

# Narrow tables of up to so many rows are broadcast; larger ones are joined.
BROADCAST_ROWS = 100_000


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """The table, stored and marked for broadcast if it has no more than `rows` rows."""
    stored = cut(df)
    return F.broadcast(stored) if stored.count() <= rows else stored


def lookup(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """`left.join(right, on, how)` for a `right` with one row per key.

    The right side is stored first. Both sides then come out of a shuffle made for this join alone, which is
    what Spark needs to split the rows of a hot key over several tasks, each with a copy of the one row looked
    up; below an aggregate it could not.
    """
    return left.join(cut(right), list(on), how)

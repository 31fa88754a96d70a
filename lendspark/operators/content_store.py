"""The store of minimised vectors, with a sketch that tells most new ones apart from what is stored without reading it.

The sketch is a blocked Bloom filter kept as a table. A vector's digest names a block of its prefix and a few of the block's 64
bits; a vector whose bits are not all set was never stored. Only the others, the vectors that are stored and few more, are
joined with the store, in the partitions of their prefixes. A wrong hit costs a lookup and never a vector.

Sketch rows are only added: every batch stores the bits it sets, and the bits of a block are put together when they are
read. `compacted` writes one row a block again. Digests are SHA-256, so that any of their digits are as good as random.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendspark.operators.skew import lookup

SKETCH = "prefix string, block bigint, bits bigint"

# Fixed: a stored sketch is read with the numbers it was written with. Some hundred million vectors at eight bits each.
_BLOCK_DIGITS = 4
_BITS = 4


def _block(digest: str) -> Column:
    """The block within the prefix, from the digits that follow the prefix's two."""
    return F.conv(F.substring(digest, 3, _BLOCK_DIGITS), 16, 10).cast("bigint")


def _mask(digest: str) -> Column:
    """The bits of a digest: six binary digits each, from further digits."""
    mask = F.lit(0).cast("bigint")
    for i in range(_BITS):
        at = F.pmod(F.conv(F.substring(digest, 3 + _BLOCK_DIGITS + 2 * i, 2), 16, 10).cast("int"), F.lit(64))
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), at))
    return mask


def sketch_of(rows: DataFrame) -> DataFrame:
    """(prefix, block, bits) of stored rows (prefix, sha256)."""
    marked = rows.select("prefix", _block("sha256").alias("block"), _mask("sha256").alias("bits"))
    return compacted(marked)


def compacted(sketch: DataFrame) -> DataFrame:
    """One row a block."""
    return sketch.groupBy("prefix", "block").agg(F.bit_or("bits").alias("bits"))


def split_by_sketch(rows: DataFrame, sketch: DataFrame) -> DataFrame:
    """`rows` (prefix, sha256, ...) with `possible`: whether the store may hold them."""
    placed = rows.withColumn("block", _block("sha256"))
    met = lookup(placed, compacted(sketch), ["prefix", "block"], "left")
    possible = F.coalesce(F.col("bits").bitwiseAND(_mask("sha256")) == _mask("sha256"), F.lit(False))
    return met.select(*rows.columns, possible.alias("possible"))


def new_vectors(rows: DataFrame, stored: DataFrame, sketch: DataFrame) -> DataFrame:
    """The rows (prefix, sha256, json), one per content, that the store does not hold yet.

    `sketch` must cover what is stored, or rows that are stored come back as new ones.
    """
    split = split_by_sketch(rows, sketch)
    possible = split.where("possible").drop("possible")
    missed = possible.join(stored.select("prefix", "sha256"), ["prefix", "sha256"], "left_anti")
    return split.where("NOT possible").drop("possible").unionByName(missed)

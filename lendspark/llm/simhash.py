"""Near-duplicate documents by SimHash fingerprints and sharded BK-trees.

Fingerprints are taken once per document and stored; equal ones are collapsed before any comparison.
A BK-tree over all fingerprints would grow with the corpus and visit most of itself at random 64-bit
values, so the trees are sharded by the pigeonhole rule: of `radius + 2` blocks of bits, two fingerprints
within the radius agree in two blocks at least. A fingerprint joins one shard for each pair of blocks, every
linked pair meets in a shard, and each shard's tree goes only to the tasks of that shard's own queries.
(The trees of the whole corpus have no size bound, so none of them is broadcast to all executors.)

A shard with more than `SHARD` fingerprints is cut into several parts, each with a tree; every two parts meet in
a group of their own, of about two `SHARD`s at most. Within a task, links are reduced to a spanning forest before they leave,
so a family of n near copies gives at most n links a shard, never all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendspark.llm.bktree import Forest, unite
from lendspark.llm.common import cut, lean, split_row
from lendspark.llm.components import components
from lendspark.operators.skew import lookup

RADIUS = 4
SHINGLE = 4
SHARD = 20_000
_HASHES_AT_ONCE = 1 << 16
_ROWS_AT_ONCE = 1 << 18

_hash = partial(xxhash.xxh64_intdigest, seed=42)


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a text's word shingles, repeats included; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    size = min(shingle, len(words))
    count = len(words) - size + 1
    ones = np.zeros(64, dtype=np.int64)
    for begin in range(0, count, _HASHES_AT_ONCE):
        end = min(count, begin + _HASHES_AT_ONCE)
        parts = [words[begin + i : end + i] for i in range(size)]
        hashes = np.fromiter(map(_hash, map(b" ".join, zip(*parts))), dtype="<u8", count=end - begin)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > count, bitorder="little").view("<u8")[0])


@lean
def _fingerprints(shingle: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = pc.cast(batch.column(2), pa.binary())
        values = np.fromiter((fingerprint(t.as_py() or b"", shingle) for t in texts), dtype=np.uint64, count=len(texts))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(values.view(np.int64))], names=["row", "id", "fp"]
        )


def fingerprints(df: DataFrame, row: Column, id_col: str, text_col: str, shingle: int = SHINGLE) -> DataFrame:
    """(row, id, fp): the fingerprint of every document as a signed long; a null text is empty."""
    narrow = df.select(row.alias("row"), F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(partial(_fingerprints, shingle), "row string, id long, fp long")


def _blocks(radius: int) -> list[tuple[int, int]]:
    """(shift, width) of radius + 2 blocks that share 64 bits as evenly as can be."""
    count = radius + 2
    widths = [64 // count + (i < 64 % count) for i in range(count)]
    return [(sum(widths[:i]), width) for i, width in enumerate(widths)]


def _shard_keys(fp: Column, radius: int) -> Column:
    def bits(shift: int, width: int) -> Column:
        return F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit((1 << width) - 1).cast("long"))

    keys = []
    for number, ((s1, w1), (s2, w2)) in enumerate(combinations(_blocks(radius), 2)):
        joined = F.shiftleft(bits(s1, w1), w2).bitwiseOR(bits(s2, w2))
        keys.append(joined.bitwiseOR(F.lit(number << 48).cast("long")))
    return F.array(*keys)


def _link_batch(group: np.ndarray, fp: np.ndarray, probe: np.ndarray, asks: np.ndarray, radius: int) -> pa.RecordBatch:
    """Spanning links of whole groups; rows of a group stand together, those of its tree first."""
    tree, queries = np.flatnonzero(~probe), np.flatnonzero(asks)
    parent = np.arange(len(fp))
    forest = Forest(fp[tree], group[tree])
    for query, node in forest.search(fp[queries], group[queries], radius):
        unite(parent, queries[query], tree[node])
    linked = np.flatnonzero(parent != np.arange(len(fp)))
    pairs = [pa.array(fp[linked].view(np.int64)), pa.array(fp[parent[linked]].view(np.int64))]
    return pa.RecordBatch.from_arrays(pairs, names=["a", "b"])


@lean
def _links(radius: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows arrive sorted by group, which has a bounded size. The last one of a run is held back until it is complete."""
    held: list[np.ndarray] = [np.empty((5, 0), dtype=np.int64)]  # key, left, right, fp, probe
    size = 0

    def columns(batch: pa.RecordBatch) -> np.ndarray:
        return np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns])

    def link(rows: np.ndarray) -> pa.RecordBatch:
        change = np.zeros(rows.shape[1], dtype=np.int64)
        change[1:] = (rows[:3, 1:] != rows[:3, :-1]).any(axis=0)
        probe = rows[4].astype(bool)
        asks = probe | (rows[1] == rows[2])
        return _link_batch(np.cumsum(change), np.ascontiguousarray(rows[3]).view(np.uint64), probe, asks, radius)

    for batch in batches:
        held.append(columns(batch))
        size += batch.num_rows
        if size < _ROWS_AT_ONCE:
            continue
        rows = np.concatenate(held, axis=1)
        last = int(np.flatnonzero((rows[:3] == rows[:3, -1:]).all(axis=0))[0])
        if last:
            yield link(rows[:, :last])
        held, size = [rows[:, last:].copy()], 0
    rows = np.concatenate(held, axis=1)
    if rows.shape[1]:
        yield link(rows)


def links(prints: DataFrame, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """(a, b): links that connect all of the distinct fingerprints `fp` within `radius` of each other."""
    keyed = prints.select(F.explode(_shard_keys(F.col("fp"), radius)).alias("key"), "fp")
    shared = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / F.lit(shard)).cast("int")
    dealt = (
        lookup(keyed, shared, ["key"])
        .select("key", "fp", parts.alias("parts"))
        .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
        .select("key", "fp", "own", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
        .select(
            "key",
            F.least("own", "other").alias("left"),
            F.greatest("own", "other").alias("right"),
            "fp",
            (F.col("own") > F.col("other")).alias("probe"),
        )
    )
    near = dealt.repartition("key", "left", "right").sortWithinPartitions("key", "left", "right", "probe", "fp")
    return near.mapInArrow(partial(_links, radius), "a long, b long")


def _classes(rows: DataFrame, radius: int) -> DataFrame:
    """(fp, root, component_id) of every distinct fingerprint of (id, fp); root is a class's smallest fingerprint."""
    prints = cut(rows.groupBy("fp").agg(F.min("id").alias("low")))
    tied = components(links(prints, radius))
    rooted = cut(prints.join(tied.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    return lookup(rooted, lowest, ["root"]).select("fp", "root", "component_id")


def near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, shingle: int = SHINGLE
) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row: the class of documents linked by close fingerprints.

    Fingerprints link at `radius` or fewer differing bits; component_id is the smallest id reachable. Null,
    empty and blank texts have fingerprint zero and are linked like any other. Repeated rows each give a row.
    Rows without an id are linked too, but never name a component unless no member has an id (then null).
    Other columns of `df` are not read. An empty table gives no rows.
    """
    rows = cut(fingerprints(df, F.lit(""), id_col, text_col, shingle).drop("row"))
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return rows.join(_classes(rows, radius), "fp").select(F.col("id").alias("doc_id"), hexed, "component_id")


def drop_near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, shingle: int = SHINGLE
) -> DataFrame:
    """One row of `df` for each class of `near_duplicates`, with all its columns: that of the smallest id.

    Of several rows with that id the first read stays; cases as above. A class whose rows all lack an id
    keeps its first row.
    """
    whole = split_row(df, [id_col, text_col])
    rows = cut(fingerprints(whole, F.col("_row"), "_0", "_1", shingle))
    classes = rows.join(_classes(rows, radius), "fp")
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "row"))
    kept = classes.groupBy("root").agg(first.alias("kept")).select("kept.row")
    return whole.join(kept.select(F.col("row").alias("_row")), "_row", "left_semi").select("_doc.*")

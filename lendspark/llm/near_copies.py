"""Near copies by the similarity of their word shingles: SimHash fingerprints in BK-trees of min-hash groups.

A similarity (Jaccard) of 0.8 over shingles of five words puts two 64-bit fingerprints some ten bits apart,
and nearly always within `RADIUS`. At that radius blocks of equal bits no longer tell near texts from others, so
the trees are sharded by min-hashes instead: `BANDS` times, texts meet that agree in `ROWS` smallest hashes.
Two texts of similarity s meet with probability 1 - (1 - s ** 3) ** 8: 0.997 at 0.8, 0.9998 at 0.87, and
hardly ever (0.008) at 0.1. In each group a BK-tree of the fingerprints finds the candidates, and the whole sets of
shingles (32 bits of each hash) decide.

Texts with equal sets of shingles are collapsed first. A group is compared only as far as its texts are not yet
connected, and gives a spanning forest, never all its pairs. A group of more than `SHARD` shingles is cut into
parts, and every two parts meet in a group of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendspark.llm.bktree import Forest, find, unite
from lendspark.llm.common import cut, lean, split_row
from lendspark.llm.components import components
from lendspark.operators.skew import lookup

SIMILARITY = 0.8
SHINGLE = 5
RADIUS = 20
BANDS, ROWS = 8, 3
# Shingles in a part of a group; a text counts as `_TEXT` more, so that the texts of a part are bounded, too.
SHARD = 4_000_000
_TEXT = 400
_AT_ONCE = 1 << 16
_BYTES_AT_ONCE = 32 << 20
# Odd multipliers: each orders the hashes anew.
_ORDERS = np.array([xxhash.xxh64_intdigest(bytes([i])) | 1 for i in range(BANDS * ROWS)], dtype=np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15)

_hash = partial(xxhash.xxh64_intdigest, seed=42)

_SET = "row string, id long, digest long, fp long, size long, hashes binary, bands array<long>"


def shingles(text: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """The distinct hashes of a text's word shingles, sorted; of fewer words the whole sequence, of none nothing."""
    words = text.lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    width = min(shingle, len(words))
    count = len(words) - width + 1
    runs = []
    for begin in range(0, count, _AT_ONCE):
        end = min(count, begin + _AT_ONCE)
        parts = zip(*(words[begin + i : end + i] for i in range(width)))
        runs.append(np.unique(np.fromiter(map(_hash, map(b" ".join, parts)), dtype=np.uint64, count=end - begin)))
    return runs[0] if len(runs) == 1 else np.unique(np.concatenate(runs))


def _fingerprint(hashes: np.ndarray) -> int:
    ones = np.zeros(64, dtype=np.int64)
    for begin in range(0, len(hashes), _AT_ONCE):
        rows = hashes[begin : begin + _AT_ONCE].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


def _bands(hashes: np.ndarray) -> np.ndarray:
    """A number for each band's smallest hashes; a text without words is in no group."""
    if not len(hashes):
        return np.empty(0, dtype=np.int64)
    lowest = np.full(len(_ORDERS), np.iinfo(np.uint64).max, dtype=np.uint64)
    for begin in range(0, len(hashes), _AT_ONCE):
        part = hashes[begin : begin + _AT_ONCE]
        for i, order in enumerate(_ORDERS):
            lowest[i] = min(lowest[i], (part * order).min())
    number = np.arange(BANDS, dtype=np.uint64)
    for column in lowest.reshape(BANDS, ROWS).T:
        number = (number ^ column) * _MIX
        number ^= number >> np.uint64(29)
    return number.view(np.int64)


@lean
def _sets(shingle: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text in pc.cast(batch.column(2), pa.binary()):
            hashes = shingles(text.as_py() or b"", shingle)
            short = np.unique((hashes >> np.uint64(32)).astype(np.uint32))
            digest = np.uint64(xxhash.xxh64_intdigest(hashes.tobytes())).view(np.int64)
            rows.append((int(digest), _fingerprint(hashes), len(short), short.tobytes(), _bands(hashes)))
        types = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()))
        columns = [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(types)]
        names = [column.split()[0] for column in _SET.split(", ")]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=names)


def shingle_sets(df: DataFrame, row: Column, id_col: str, text_col: str, shingle: int = SHINGLE) -> DataFrame:
    """(row, id, digest, fp, size, hashes, bands): the shingles of every text; a null text is empty."""
    narrow = df.select(row.alias("row"), F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(partial(_sets, shingle), _SET)


def resemblance(a: np.ndarray, b: np.ndarray) -> float:
    """The similarity of two sets of hashes, each without repeats."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / max(1, len(a) + len(b) - common)


def _forest(group: pa.Table, similarity: float, radius: int) -> pa.RecordBatch:
    """Spanning links of whole groups; rows of a group stand together, those of its tree first."""
    key, left, right, digest, fp, size, probe = (
        group.column(c).to_numpy() for c in ("key", "left", "right", "digest", "fp", "size", "probe")
    )
    sets = group.column("hashes").combine_chunks()
    change = np.zeros(len(key), dtype=np.int64)
    change[1:] = (key[1:] != key[:-1]) | (left[1:] != left[:-1]) | (right[1:] != right[:-1])
    shard, prints = np.cumsum(change), fp.view(np.uint64)
    tree, asks = np.flatnonzero(~probe), np.flatnonzero(probe | (left == right))
    parent = np.arange(len(key))
    trees = Forest(prints[tree], shard[tree])
    for query, node in trees.search(prints[asks], shard[asks], radius):
        a, b = asks[query], tree[node]
        fits = (a > b) & (np.minimum(size[a], size[b]) >= similarity * np.maximum(size[a], size[b]))
        a, b, step = a[fits], b[fits], 256
        while len(a):
            apart = find(parent, a) != find(parent, b)
            a, b = a[apart], b[apart]
            asked = zip(a[:step].tolist(), b[:step].tolist())
            linked = np.array([resemblance(_set(sets, i), _set(sets, j)) >= similarity for i, j in asked], dtype=bool)
            unite(parent, a[:step][linked], b[:step][linked])
            a, b, step = a[step:], b[step:], 2 * step
    linked = np.flatnonzero(parent != np.arange(len(key)))
    return pa.RecordBatch.from_arrays([pa.array(digest[linked]), pa.array(digest[parent[linked]])], names=["a", "b"])


def _set(column: pa.Array, row: int) -> np.ndarray:
    return np.frombuffer(column[row].as_buffer(), dtype=np.uint32)


@lean
def _links(similarity: float, radius: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows arrive sorted by group. The last group of a run is held back until it is complete."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.nbytes for b in held) < _BYTES_AT_ONCE:
            continue
        rows = pa.Table.from_batches(held).combine_chunks()
        ends = [rows.column(c).to_numpy() for c in ("key", "left", "right")]
        last = int(np.flatnonzero(np.logical_and.reduce([e == e[-1] for e in ends]))[0])
        if last:
            yield _forest(rows.slice(0, last), similarity, radius)
        held = rows.slice(last).to_batches()
    if held:
        yield _forest(pa.Table.from_batches(held).combine_chunks(), similarity, radius)


def links(sets: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """(a, b): links that connect the `digest`s of similar shingle sets; a set may have several rows."""
    keyed = sets.dropDuplicates(["digest"]).select(F.explode("bands").alias("key"), "digest", "size")
    weight = F.sum(F.col("size") + _TEXT)
    shared = keyed.groupBy("key").agg(F.count("*").alias("n"), weight.alias("weight")).where("n > 1")
    parts = F.ceil(F.col("weight") / F.lit(shard)).cast("int")
    own = F.pmod(F.xxhash64("digest"), F.col("parts")).cast("int")
    met = (
        lookup(keyed.drop("size"), shared, ["key"])
        .select("key", "digest", parts.alias("parts"))
        .withColumn("own", own)
        .select("key", "digest", "own", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
        .select(
            "key",
            F.least("own", "other").alias("left"),
            F.greatest("own", "other").alias("right"),
            (F.col("own") > F.col("other")).alias("probe"),
            "digest",
        )
    )
    met = cut(met)
    first = F.any_value(F.struct("fp", "size", "hashes")).alias("first")
    asked = sets.join(met.select("digest").distinct(), "digest", "left_semi").groupBy("digest").agg(first)
    wide = met.join(asked.select("digest", "first.*"), "digest")
    ordered = wide.select("key", "left", "right", "digest", "fp", "size", "hashes", "probe")
    ordered = ordered.repartition("key", "left", "right").sortWithinPartitions("key", "left", "right", "probe", "digest")
    return ordered.mapInArrow(partial(_links, similarity, radius), "a long, b long")


def drop_near_copies(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    similarity: float = SIMILARITY,
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    shard: int = SHARD,
) -> DataFrame:
    """One row of `df`, with all its columns, for each class of texts linked by similar shingles: that of the smallest id.

    Words are told apart by ASCII blanks, A to Z lower-cased. Texts link if their sets of shingles have the
    similarity or more. A text of fewer words than a shingle is one shingle; null, empty and blank texts have
    none and are one class. Of several rows with the smallest id the first read stays; repeated rows are one class.
    Rows without an id stay only where no row of their class has one, and of these the first. An empty table
    gives no rows. The other columns may have any names.
    """
    whole = split_row(df, [id_col, text_col])
    rows = cut(shingle_sets(whole, F.col("_row"), "_0", "_1", shingle))
    tied = components(links(rows, similarity, radius, shard))
    rooted = lookup(rows.select("row", "id", "digest"), tied.withColumnRenamed("node", "digest"), ["digest"], "left")
    smallest = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "row"))
    kept = rooted.groupBy(F.coalesce("root", "digest").alias("class")).agg(smallest.alias("kept")).select("kept.row")
    return whole.join(kept.select(F.col("row").alias("_row")), "_row", "left_semi").select("_doc.*")

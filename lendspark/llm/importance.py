"""Importance resampling towards a target: documents whose hashed n-grams look like the target's are drawn more often.

A feature is a run of one to three consecutive words joined by one space; its bucket is the CRC-32 of its bytes
modulo `BUCKETS`. Two passes read the texts: the first counts the features of every bucket, the second adds up
each document's gains. A pass works on the texts of one Arrow batch at a time, in arrays:

1. The words of the batch are copied, lower-cased and one space apart, into one array of bytes, so that every
   feature is a slice of it. Words, then pairs, then triples are numbered by what they hold, so that a
   feature that occurs again is hashed once.
2. Distinct features of equal length form a matrix of bytes. All their CRCs are updated together, one column
   after the other, and scattered back to the places where the features stand. Features of more than `COLUMNS`
   bytes, which would be matrices of a row or two with very many columns, are hashed by zlib one by one.

What a task sends back are `BUCKETS` counts at most, whatever it has read. The drawing sorts narrow rows by range
and numbers them from the size of each range, so that no task and no driver sees all of them.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendspark.llm.common import cut, lean, split_row, text_of
from lendspark.operators.skew import small

BUCKETS = 10_000
LONGEST = 3
LEAST_WORDS = 20
PERCENT = 5
SEED = 42
COLUMNS = 256
_CELLS_AT_ONCE = 1 << 22

_BYTES = np.arange(256)
_LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
# 0 to 9, a to z and every byte of a character beyond ASCII.
_IN_WORD = ((_BYTES >= 48) & (_BYTES <= 57)) | ((_LOWER >= 97) & (_LOWER <= 122)) | (_BYTES >= 128)


def _crc_table() -> np.ndarray:
    """The CRC of every byte: the reversed polynomial of CRC-32, divided bit by bit."""
    crc = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        crc = np.where(crc & 1, (crc >> 1) ^ np.uint32(0xEDB88320), crc >> 1)
    return crc.astype(np.uint32)


_CRC = _crc_table()


def crcs(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The CRC-32 of every slice of `data`, by matrices of slices of equal length."""
    out = np.empty(len(start), dtype=np.uint32)
    order = np.argsort(size, kind="stable")
    lengths, first = np.unique(size[order], return_index=True)
    for length, at, end in zip(lengths.tolist(), first.tolist(), [*first[1:].tolist(), len(order)]):
        same = order[at:end]
        if length > COLUMNS:
            whole = memoryview(np.ascontiguousarray(data))
            out[same] = [zlib.crc32(whole[s : s + length]) for s in start[same].tolist()]
            continue
        step = max(1, _CELLS_AT_ONCE // max(length, 1))
        for i in range(0, len(same), step):
            some = same[i : i + step]
            columns = data[start[some] + np.arange(length)[:, None]]
            crc = np.full(len(some), 0xFFFFFFFF, dtype=np.uint32)
            for column in columns:
                crc = _CRC[(crc ^ column) & 0xFF] ^ (crc >> 8)
            out[some] = ~crc
    return out


def _numbered(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A number for every slice, the same for equal slices only."""
    number = np.empty(len(start), dtype=np.int64)
    order = np.argsort(size, kind="stable")
    lengths, first = np.unique(size[order], return_index=True)
    used = 0
    for length, at, end in zip(lengths.tolist(), first.tolist(), [*first[1:].tolist(), len(order)]):
        same = order[at:end]
        if length <= 8:
            key = np.zeros(len(same), dtype=np.uint64)
            for i in range(length):
                key = (key << np.uint64(8)) | data[start[same] + i]
        else:
            rows = np.empty((len(same), length), dtype=np.uint8)
            for i in range(length) if length <= COLUMNS else ():
                rows[:, i] = data[start[same] + i]
            if length > COLUMNS:
                for i, s in enumerate(start[same].tolist()):
                    rows[i] = data[s : s + length]
            key = rows.view(f"V{length}").ravel()
        distinct, inverse = np.unique(key, return_inverse=True)
        number[same] = used + inverse.ravel()
        used += len(distinct)
    return number


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of every feature, text it stands in, words per text) of a batch of texts without nulls."""
    count = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset : texts.offset + count + 1].astype(np.int64)
    held = texts.buffers()[2]
    data = np.frombuffer(held, dtype=np.uint8)[offsets[0] : offsets[-1]] if held is not None else np.empty(0, dtype=np.uint8)
    offsets = offsets - offsets[0]
    inside = _IN_WORD[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    fresh = offsets[:-1][offsets[:-1] < len(data)]  # a word never goes on into the next text
    first[fresh] = inside[fresh]
    at = np.flatnonzero(first)
    text = np.searchsorted(offsets, at, side="right") - 1
    words = np.bincount(text, minlength=count).astype(np.int64)
    if not len(at):
        return np.empty(0, dtype=np.int64), text, words
    size = np.add.reduceat(inside.astype(np.int64), at)
    spaced = np.full(int(size.sum()) + len(size), 32, dtype=np.uint8)
    spaced[np.arange(len(spaced) - len(size)) + np.repeat(np.arange(len(size)), size)] = _LOWER[data[inside]]
    start = np.cumsum(size + 1) - (size + 1)
    word = _numbered(spaced, start, size)
    run, buckets, owners = word, [], []
    for n in range(1, LONGEST + 1):
        whole = np.flatnonzero(text[: len(text) - n + 1] == text[n - 1 :])
        if n > 1:  # a run is numbered by the run it goes on from, and its last word
            run = run[: len(word) - n + 1] * (int(word.max()) + 1) + word[n - 1 :]
        _, place, inverse = np.unique(run[whole], return_index=True, return_inverse=True)
        run = np.zeros_like(run)
        run[whole] = inverse.ravel()
        place = whole[place]
        length = start[place + n - 1] + size[place + n - 1] - start[place]
        buckets.append((crcs(spaced, start[place], length) % BUCKETS)[inverse.ravel()].astype(np.int64))
        owners.append(text[whole])
    return np.concatenate(buckets), np.concatenate(owners), words


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = np.zeros(BUCKETS, dtype=np.int64)
    for batch in batches:
        held += np.bincount(features(batch.column(0))[0], minlength=BUCKETS)
    used = np.flatnonzero(held)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(held[used])], names=["bucket", "held"])


def bucket_counts(texts: DataFrame) -> DataFrame:
    """(bucket, held) of the one column of `texts`."""
    return texts.mapInArrow(lean(_tally), "bucket long, held long").groupBy("bucket").agg(F.sum("held").alias("held"))


def _counts(texts: DataFrame) -> np.ndarray:
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for row in bucket_counts(texts).collect():  # BUCKETS rows at most
        counts[row["bucket"]] = row["held"]
    return counts


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """What one feature of each bucket adds to a weight: 1000 times the log of its share in the target, by that in the
    source, with one more in every bucket."""
    s_all, t_all = float(source.sum()), float(target.sum())
    found = [
        math.floor(1000 * math.log((t + 1.0) * (s_all + BUCKETS) / ((s + 1.0) * (t_all + BUCKETS))))
        for s, t in zip(source.tolist(), target.tolist())
    ]
    return np.array(found, dtype=np.int64)


def _weigh(shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    gain = shared.value
    for batch in batches:
        bucket, text, words = features(batch.column(1))
        order = np.argsort(text, kind="stable")
        sums = np.concatenate([[0], np.cumsum(gain[bucket[order]])])
        ends = np.searchsorted(text[order], np.arange(batch.num_rows + 1))
        weight = sums[ends[1:]] - sums[ends[:-1]]
        columns = [batch.column(0), pa.array(words), pa.array(np.diff(ends).astype(np.int64)), pa.array(weight)]
        yield pa.RecordBatch.from_arrays(columns, names=["key", "n_words", "n_features", "weight"])


def _luck(id_text: Column) -> Column:
    """The Gumbel noise of an id, in thousandths: adding it to log weights and taking the largest draws by weight."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{SEED}:"), id_text), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def _ranked(scored: DataFrame, order: list[Column], wanted: int) -> DataFrame:
    """`scored` with the place of each row in `order`, as far as `wanted`; null beyond."""
    # Ids of task and row in one number: rows of a range are counted up in their order.
    numbered = cut(scored.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()))
    part = F.shiftright("at", 33)
    sizes = sorted((r["part"], r["count"]) for r in numbered.groupBy(part.alias("part")).count().collect())  # a row per shuffle partition
    before, so_far = [], 0
    for number, size in sizes:
        before.append((number, so_far))
        so_far += size
    ranges = small(scored.sparkSession.createDataFrame(before, "part long, before long"))
    place = F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1) + 1
    joined = numbered.withColumn("part", part).join(ranges, "part")
    return joined.select(*scored.columns, F.when(place <= wanted, place).alias("rank"))


def _drawn(rows: DataFrame, target: DataFrame, percent: int) -> DataFrame:
    """(key, id, n_features, weight, score, rank) of every row of (key, id, text); `key` may be anything."""
    gain = gains(_counts(rows.select("text")), _counts(target))
    shared = rows.sparkSession.sparkContext.broadcast(gain)
    named = rows.select(F.struct("key", "id").alias("key"), "text")
    schema = f"key {named.schema['key'].dataType.simpleString()}, n_words long, n_features long, weight long"
    weighed = named.mapInArrow(lean(partial(_weigh, shared)), schema)
    id_text = F.coalesce(F.col("key.id").cast("string"), F.lit(""))
    scored = cut(
        weighed.select("key.key", "key.id", "n_words", "n_features", "weight", (F.col("weight") + _luck(id_text)).alias("score")).withColumn(
            "salt", F.rand(SEED)  # stored with the row: repeats of one row need not all go to one range
        )
    )
    columns = ["key", "id", "n_features", "weight", "score"]
    fit = scored.where(F.col("n_words") >= LEAST_WORDS)
    wanted = percent * fit.count() // 100
    ranked = _ranked(fit.select(*columns, "salt"), [F.desc("score"), F.asc_nulls_last("id"), F.asc("salt")], wanted)
    rest = scored.where(F.col("n_words") < LEAST_WORDS).select(*columns, F.lit(None).cast("long").alias("rank"))
    return ranked.select(*columns, "rank").unionByName(rest)


def resample(
    df: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", percent: int = PERCENT
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row of `df`, drawn towards the texts of `target`.

    A null text counts as empty: no features, weight 0, score from the id alone. Only documents of LEAST_WORDS words
    are drawn, `percent` in a hundred of them, rounded down; `rank` is null for all others. Ties in score go to the
    smaller id, null ids last; their noise is that of an empty id. Repeated rows are ranked one after the
    other. An empty target weighs every bucket by the source alone; an empty `df` gives no rows. Other
    columns are not read.
    """
    rows = df.select(F.lit(0).alias("key"), F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    found = _drawn(rows, target.select(text_of(target_col)), percent)
    return found.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


def drawn_rows(
    df: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", percent: int = PERCENT
) -> DataFrame:
    """The rows of `df` that `resample` draws, with all their columns; other cases as there."""
    rows = split_row(df, [id_col, text_col])
    named = rows.select(F.col("_row").alias("key"), F.col("_0").alias("id"), F.coalesce("_1", F.lit("")).alias("text"))
    drawn = _drawn(named, target.select(text_of(target_col)), percent).where(F.col("rank").isNotNull())
    return rows.join(cut(drawn.select(F.col("key").alias("_row"))), "_row").select("_doc.*")

"""Documents as blocks of codes, and the exchange that looks up every distinct word of the corpus once.

Exploding each occurrence of each word would move several times the corpus. Here a task turns the documents
it reads into blocks: the distinct words of a block are numbered as they come, and for every position of
every document there is the number of its word. Numbers leave in compressed chunks while the block goes on, so
that a worker holds its distinct words and little else. Blocks are stored, bucketed by their number. Then

* only (word, place of the word in its block) is exploded and shuffled by word: a word that makes up a third
  of the corpus is one row per block, and a task sees all rows of a word together;
* what is looked up for the word (token ids, corpus counts) goes back to its blocks, packed;
* chunks join what came back without being moved, and documents are put together again by position.

A block closes at `BLOCK_BYTES` of text, or with the task; one longer text is a block of its own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendspark.llm.common import lean, scratch_path
from lendspark.session import discard_later

BLOCK_BYTES = 64 << 20
CHUNK_WORDS = 1 << 20
WORDS_AT_ONCE = 1 << 17

# A place is one number: the block (task, then block within the task) and the number of the word in it.
_TASK_BITS, NUMBER_BITS = 14, 28

_TYPES = "block long, payload array<string>, lens array<int>, codes binary, first int, words array<binary>, counts array<int>"
PACK = "block long, numbers binary, sizes binary, values binary"
_LISTED = 1 << 14  # words in a row


class _Block:
    """The distinct words of a block, and the documents of the chunk that is being filled."""

    def __init__(self, block: int):
        self.block, self.words, self.bytes = block, {}, 0
        self.learned = np.zeros(0, dtype=np.int64)
        self.start()

    def start(self) -> None:
        self.payload, self.lens, self.codes, self.size = [], [], [], 0
        self.to_learn: list[np.ndarray] = []

    def add(self, payload: str, words: list, size: int, learn: bool) -> None:
        number = self.words
        codes = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.uint32, count=len(words))
        self.payload.append(payload)
        self.lens.append(len(words))
        self.codes.append(codes)
        if learn:
            self.to_learn.append(codes)
        self.bytes += size
        self.size += len(words)

    def _row(self, payload=None, lens=None, codes=None, first=None, words=None, counts=None) -> pa.RecordBatch:
        columns = [
            pa.array([self.block], pa.int64()),
            pa.array([payload], pa.list_(pa.string())),
            pa.array([lens], pa.list_(pa.int32())),
            pa.array([codes], pa.binary()),
            pa.array([first], pa.int32()),
            pa.array([words], pa.list_(pa.binary())),
            pa.array([counts], pa.list_(pa.int32())),
        ]
        return pa.RecordBatch.from_arrays(columns, names=[t.split()[0] for t in _TYPES.split(", ")])

    def chunk(self) -> pa.RecordBatch:
        counts = np.zeros(len(self.words), dtype=np.int64)
        counts[: len(self.learned)] = self.learned
        if self.to_learn:
            counts += np.bincount(np.concatenate(self.to_learn), minlength=len(counts))
        self.learned = counts
        row = self._row(self.payload, self.lens, _squeeze(np.concatenate(self.codes), 3))
        self.start()
        return row

    def listed(self) -> Iterator[pa.RecordBatch]:
        words = list(self.words)
        for first in range(0, len(words), _LISTED):
            part = slice(first, first + _LISTED)
            yield self._row(first=first, words=words[part], counts=self.learned[part].astype(np.int32))


@lean
def _build(split: Callable[[bytes], list], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block = _Block(TaskContext.get().partitionId() << _TASK_BITS)
    for batch in batches:
        learn = batch.column(2).to_pylist()
        for i, (payload, text) in enumerate(zip(batch.column(0).to_pylist(), pc.cast(batch.column(1), pa.binary()))):
            data = text.as_py() or b""
            if block.bytes and block.bytes + len(data) > BLOCK_BYTES:
                if block.lens:
                    yield block.chunk()
                yield from block.listed()
                block = _Block(block.block + 1)
            block.add(payload, split(data), len(data), learn[i])
            if block.size >= CHUNK_WORDS:
                yield block.chunk()
    if block.lens:
        yield block.chunk()
    yield from block.listed()


def _buckets(spark: SparkSession) -> int:
    """As many buckets as shuffle partitions: this is how a session says how widely to deal its data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def store_blocks(df: DataFrame, split: Callable[[bytes], list]) -> DataFrame:
    """Blocks of `df` (payload: string, text: string, learn: boolean), stored in buckets of their number.

    `split` gives the words of a text, as bytes; `counts` of a block counts its words in texts to learn from.
    """
    built = df.select("payload", "text", "learn").mapInArrow(partial(_build, split), _TYPES)
    path = scratch_path(df.sparkSession, "blocks")
    name = path.rpartition("/")[2].replace("-", "_")
    discard_later(path, name)
    writer = built.write.option("path", path).option("compression", "zstd").option("parquet.block.size", str(32 << 20))
    writer.bucketBy(_buckets(df.sparkSession), "block").saveAsTable(name)
    return df.sparkSession.table(name)


def words_of(blocks: DataFrame) -> DataFrame:
    """(word, place, count) by word: all rows of a word follow each other in one task."""
    listed = blocks.where("words is not null")
    rows = listed.select("block", "first", F.posexplode(F.arrays_zip("words", "counts")).alias("number", "w"))
    place = F.shiftleft("block", NUMBER_BITS).bitwiseOR((F.col("first") + F.col("number")).cast("long"))
    rows = rows.select(F.col("w.words").alias("word"), place.alias("place"), F.col("w.counts").alias("count"))
    return rows.repartition("word").sortWithinPartitions("word")


def whole_words(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Runs of rows of `words_of` that hold all rows of their words, with the place of each word's first row."""
    held: list[pa.RecordBatch] = []
    size = 0

    def run(rows: pa.Table, last: bool):
        words = rows.column(0).combine_chunks()
        change = np.ones(len(words), dtype=bool)
        change[1:] = pc.not_equal(words[1:], words[:-1]).to_numpy(zero_copy_only=False)
        first = np.flatnonzero(change)
        stop = len(words) if last else int(first[-1])
        return rows.slice(0, stop), first[first < stop], rows.slice(stop)

    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= WORDS_AT_ONCE:
            done, first, rest = run(pa.Table.from_batches(held), last=False)
            if done.num_rows:
                yield done, first
            held, size = rest.to_batches(), 0  # a word's rows, one per block, wait for the rest of them
    if held and sum(b.num_rows for b in held):
        done, first, _ = run(pa.Table.from_batches(held), last=True)
        yield done, first


def packed(place: np.ndarray, size: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
    """One row per block: the numbers of words (as steps), how many values each has, and the values."""
    order = np.argsort(place, kind="stable")
    size, values = size[order], values[gather((np.cumsum(size) - size)[order], size[order])]
    block, number = place[order] >> NUMBER_BITS, place[order] & ((1 << NUMBER_BITS) - 1)
    blocks, first = np.unique(block, return_index=True)
    value_ends = np.cumsum(size)
    rows = []
    for begin, end in zip(first, [*first[1:], len(order)]):
        low = value_ends[begin - 1] if begin else 0
        steps = np.diff(number[begin:end], prepend=0).astype(np.int32)
        rows.append([_squeeze(x) for x in (steps, size[begin:end].astype(np.int32), values[low : value_ends[end - 1]])])
    columns = [pa.array(blocks, pa.int64()), *[pa.array(list(c), pa.binary()) for c in zip(*rows)]]
    return pa.RecordBatch.from_arrays(columns, names=["block", "numbers", "sizes", "values"])


def _squeeze(values: np.ndarray, level: int = 1) -> bytes:
    return zstandard.compress(values.tobytes(), level)


def _unsqueeze(data: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), dtype=kind)


def gather(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Indices of the ranges [start, start + size) one after the other."""
    total = int(size.sum())
    return np.arange(total, dtype=np.int64) + np.repeat(start - (np.cumsum(size) - size), size)


def join_back(blocks: DataFrame, packs: DataFrame) -> DataFrame:
    """Chunks with what was looked up for their words; a block's packs together are as small as its words.

    Packs are dealt as the buckets are, so that neither they move again nor the chunks at all.
    """
    dealt = packs.repartition(_buckets(packs.sparkSession), "block").groupBy("block")
    back = dealt.agg(F.collect_list(F.struct("numbers", "sizes", "values")).alias("packs"))
    chunks = blocks.where("codes is not null").select("block", "payload", "lens", "codes")
    return chunks.join(back.hint("merge"), "block", "left").select("payload", "lens", "codes", "packs")


def looked_up(packs: list[dict] | None, kind) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, size, values) by a word's number in its block."""
    if not packs:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), np.empty(0, dtype=kind)
    number = np.concatenate([np.cumsum(_unsqueeze(p["numbers"], np.int32), dtype=np.int64) for p in packs])
    sizes = np.concatenate([_unsqueeze(p["sizes"], np.int32) for p in packs]).astype(np.int64)
    values = np.concatenate([_unsqueeze(p["values"], kind) for p in packs])
    start, size = np.empty(len(number), dtype=np.int64), np.empty(len(number), dtype=np.int64)
    start[number] = np.cumsum(sizes) - sizes
    size[number] = sizes
    return start, size, values


def codes_of(raw: bytes) -> np.ndarray:
    return _unsqueeze(raw, np.uint32)

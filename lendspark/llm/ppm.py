"""Scoring by prediction by partial matching (PPM) over bytes, with escape method D and symbol exclusion.

Training counts, over all texts to learn from, how often each byte follows each context of `ORDER` bytes; the
counts of shorter contexts are sums of these, so the whole trie comes out of one table. A byte never seen
in a context costs an escape to the next shorter one, where the bytes of the longer context are excluded.
Half a count of every byte seen in a context goes to its escape.
As every byte seen after a context was also seen after its suffix, what exclusion takes away depends on the
longer context alone and is worked out once per context, by joins.

The trie grows with the corpus, so it is cut into shards of bounded size by the two bytes before the one to
be predicted; contexts of one byte or none (at most 65,792 entries) are part of every shard. Each shard is
one sorted file, sent along with the application's files. A task scores a few megabytes of text at a time,
holding one shard after the other; each adds the code length of the positions that belong to it.

The base score of words needs the count of every word of the corpus: see `blocks`.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendspark.llm import blocks
from lendspark.llm.common import cut, lean, scratch_path
from lendspark.session import discard_later

ORDER = 5
SHARD_ROWS = 1_000_000
EDGE = 0xFF  # stands before and after a text; no UTF-8 text contains it
END = b"\xff"  # the token that ends a text in the base score
_AT_ONCE = 1 << 20
_HELD = 1 << 21
_TEXT_AT_ONCE = 16 << 20


def _mask(size: int) -> int:
    return (1 << (8 * size)) - 1


def grams_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(grams, count per text): for each byte of a text and its end, the ORDER bytes before it and itself."""
    pad, end = bytes([EDGE] * ORDER), bytes([EDGE])
    data = np.frombuffer(b"".join(part for t in texts for part in (pad, t, end)), dtype=np.uint8)
    sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    codes = np.zeros(max(0, len(data) - ORDER), dtype=np.int64)
    for i in range(ORDER + 1):
        codes <<= 8
        codes |= data[i : len(data) - ORDER + i]
    wanted = np.ones(len(codes), dtype=bool)
    inner = np.cumsum(sizes + ORDER)[:-1]  # where the next text's padding begins, less the shift of a gram
    for i in range(ORDER):
        wanted[inner - ORDER + i] = False
    return codes[wanted], sizes


def _chunks(column: pa.Array) -> Iterator[list[bytes]]:
    part, size = [], 0
    for value in pc.cast(column, pa.binary()):
        data = value.as_py() or b""
        if part and size + len(data) > _AT_ONCE:
            yield part
            part, size = [], 0
        part.append(data)
        size += len(data)
    if part:
        yield part


@lean
def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keys, counts = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def merged():
        every = np.concatenate([keys, *[k for k, _ in waiting]])
        weights = np.concatenate([counts, *[c for _, c in waiting]])
        order = np.argsort(every, kind="stable")
        every, weights = every[order], weights[order]
        first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]])) if len(every) else np.empty(0, dtype=np.int64)
        return every[first], np.add.reduceat(weights, first) if len(first) else weights

    for batch in batches:
        for texts in _chunks(batch.column(0)):
            part = np.unique(grams_of(texts)[0], return_counts=True)
            waiting.append(part)
            size += len(part[0])
            if size > _HELD:
                keys, counts = merged()
                waiting, size = [], 0
                if len(keys) > _HELD:  # more than a task should hold; the aggregate adds them up
                    yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], names=["gram", "n"])
                    keys, counts = keys[:0], counts[:0]
    keys, counts = merged()
    yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], names=["gram", "n"])


def train(texts: DataFrame) -> DataFrame:
    """(kind, key, n, q, e) of the trie of the column `text`, stored.

    Kind j (0 to ORDER): a gram of j + 1 bytes and its count n. Kind 10 + j: a context of j bytes, the bytes n
    and different bytes q that follow it, and how often those follow its suffix, e.
    """
    level = cut(texts.select("text").mapInArrow(_count, "gram long, n long").groupBy(F.col("gram").alias("key")).agg(F.sum("n").alias("n")))
    entries = {ORDER: level}
    for j in range(ORDER - 1, -1, -1):
        short = F.col("key").bitwiseAND(F.lit(_mask(j + 1)).cast("long")).alias("key")
        entries[j] = level = cut(level.groupBy(short).agg(F.sum("n").alias("n")))
    tables = []
    none = F.lit(0).cast("long")
    for j, entry in entries.items():
        tables.append(entry.select(F.lit(j).alias("kind"), "key", "n", none.alias("q"), none.alias("e")))
        context = F.shiftrightunsigned("key", 8)
        if j:
            shorter = entries[j - 1].select(F.col("key").alias("short"), F.col("n").alias("below"))
            entry = entry.withColumn("short", F.col("key").bitwiseAND(F.lit(_mask(j)).cast("long"))).join(shorter, "short")
        else:
            entry = entry.withColumn("below", none)
        sums = entry.groupBy(context.alias("key")).agg(F.sum("n").alias("n"), F.count("*").alias("q"), F.sum("below").alias("e"))
        tables.append(sums.select(F.lit(10 + j).alias("kind"), "key", "n", "q", "e"))
    whole = tables[0]
    for other in tables[1:]:
        whole = whole.unionByName(other)
    return cut(whole)


def _shard(before, shards: int):
    """The shard of the two bytes before a position; the same arithmetic on numbers, arrays and columns."""
    return (before * 40503 % 65536) * shards


def shard_files(model: DataFrame) -> list[str]:
    """Store the shards of a trie, one sorted file each; a shard has SHARD_ROWS rows or so."""
    shards = max(1, -(-model.count() // SHARD_ROWS))
    order = F.col("kind") % 10
    last_two = F.when(F.col("kind") < 10, F.shiftrightunsigned("key", 8)).otherwise(F.col("key")).bitwiseAND(F.lit(0xFFFF).cast("long"))
    own = F.floor(_shard(last_two, shards) / F.lit(65536)).cast("int")
    every = F.sequence(F.lit(0), F.lit(shards - 1))
    placed = model.withColumn("shard", F.explode(F.when(order < 2, every).otherwise(F.array(own))))
    spark = model.sparkSession
    path = scratch_path(spark, "trie")
    discard_later(path)
    sorted_ = placed.repartition("shard").sortWithinPartitions("shard", "kind", "key")
    sorted_.write.partitionBy("shard").parquet(path)
    files = {int(re.search(r"/shard=(\d+)/", f)[1]): f for f in spark.read.schema(placed.schema).parquet(path).inputFiles()}
    return [_renamed(spark, files[shard], f"{path.rpartition('/')[2]}-{shard}.parquet") for shard in sorted(files)]


def _renamed(spark: SparkSession, file: str, name: str) -> str:
    """Give a stored file a name that no other file of the application has."""
    old = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(file)
    new = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(old.getParent(), name)
    old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).rename(old, new)
    return new.toString()


@lru_cache(maxsize=1)
def load(path: str) -> dict[int, tuple[np.ndarray, ...]]:
    """Keys and figures of each kind from a shard's file: n of grams; n, q and e of contexts. No file, no figures."""
    if path:
        rows = pq.read_table(path, columns=["kind", "key", "n", "q", "e"], partitioning=None)
    else:
        rows = pa.table({name: pa.array([], pa.int64()) for name in ("kind", "key", "n", "q", "e")})
    kind = rows.column("kind").to_numpy()
    found: dict[int, tuple[np.ndarray, ...]] = {}
    for k in [*range(ORDER + 1), *range(10, 11 + ORDER)]:
        begin, end = np.searchsorted(kind, [k, k + 1])
        names = ("key", "n") if k < 10 else ("key", "n", "q", "e")
        found[k] = tuple(rows.column(c).slice(begin, end - begin).to_numpy() for c in names)
    keys, counts = found.pop(ORDER)
    n = _look(found[10 + ORDER], keys >> 8, 1)
    found[-1] = (keys, np.log10((counts - 0.5) / np.maximum(n, 1)))
    return found


def _look(table: tuple[np.ndarray, ...], keys: np.ndarray, column: int) -> np.ndarray:
    """Values by key, 0 where there is none."""
    known = table[0]
    if not len(known):
        return np.zeros(len(keys), dtype=np.int64)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return np.where(known[at] == keys, table[column][at], 0)


def log_probability(model: dict[int, tuple[np.ndarray, ...]], grams: np.ndarray) -> np.ndarray:
    """log10 of the probability of each gram's last byte after the others."""
    known, values = model[-1]
    out = np.zeros(len(grams))
    missed = np.ones(len(grams), dtype=bool)
    if len(known):
        at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
        missed = known[at] != grams
        out = np.where(missed, 0.0, values[at])
    rest = np.flatnonzero(missed)
    gram = grams[rest]
    total = np.zeros(len(gram))
    going = np.ones(len(gram), dtype=bool)
    excluded_n, excluded_q = np.zeros(len(gram)), np.zeros(len(gram))
    for j in range(ORDER, -1, -1):
        context = (gram >> 8) & _mask(j)
        n, q, e = (_look(model[10 + j], context, i).astype(np.float64) for i in (1, 2, 3))
        seen = _look(model[j], gram & _mask(j + 1), 1).astype(np.float64) if j < ORDER else np.zeros(len(gram))
        new = q - excluded_q
        room = np.maximum(n - excluded_n, 1.0)
        here = going & (seen > 0)
        total[here] += np.log10((seen[here] - 0.5) / room[here])
        going &= ~here
        escape = going & (new > 0)
        total[escape] += np.log10(new[escape] / 2 / room[escape])
        excluded_n, excluded_q = e, q
    total[going] -= np.log10(np.maximum(256.0 - excluded_q[going], 1.0))
    out[rest] = total
    return out


@lean
def _score(files: list[str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def scored(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # All texts under one shard, then under the next: with many shards each is read once for many texts.
        totals = [np.zeros(batch.num_rows) for batch in held]
        for shard, name in enumerate(files):
            model = load(SparkFiles.get(name) if name else "")
            for batch, total in zip(held, totals):
                at = 0
                for texts in _chunks(batch.column(1)):
                    grams, sizes = grams_of(texts)
                    own = np.flatnonzero(_shard((grams >> 8) & 0xFFFF, len(files)) // 65536 == shard)
                    value = np.zeros(len(grams))
                    value[own] = log_probability(model, grams[own])
                    total[at : at + len(texts)] += np.add.reduceat(value, np.cumsum(sizes) - sizes)
                    at += len(texts)
        for batch, total in zip(held, totals):
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(total)], names=["id", "text", "learn", "score"])

    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= _TEXT_AT_ONCE:
            yield from scored(held)
            held, size = [], 0
    if held:
        yield from scored(held)


def score(df: DataFrame, model: DataFrame) -> DataFrame:
    """Add `score` to (id, text, learn)."""
    context = df.sparkSession.sparkContext
    files = shard_files(model)
    for file in files:
        context.addFile(file)
    names = [file.rpartition("/")[2] for file in files] or [""]
    return df.mapInArrow(partial(_score, names), "id long, text string, learn boolean, score double")


def _tokens(text: bytes) -> list[bytes]:
    return [*text.lower().split(), END]


@lean
def _look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, first in blocks.whole_words(batches):
        place, count = (rows.column(i).to_numpy() for i in (1, 2))
        sums = np.add.reduceat(count.astype(np.int64), first)
        times = np.diff([*first, rows.num_rows])
        packs = blocks.packed(place, np.ones(len(place), dtype=np.int64), np.repeat(sums, times))
        tally = np.zeros((2, packs.num_rows), dtype=np.int64)
        tally[:, 0] = np.count_nonzero(sums), sums.sum()
        yield pa.RecordBatch.from_arrays([*packs.columns, *map(pa.array, tally)], names=[*packs.schema.names, "distinct", "total"])


@lean
def _assemble(total: int, distinct: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    space = total + 0.5 * (distinct + 1)
    for batch in batches:
        for row in range(batch.num_rows):
            payload, lens, raw, packs = (batch.column(i)[row].as_py() for i in range(4))
            start, _, values = blocks.looked_up(packs, np.int64)
            by_number = values[start]
            codes = blocks.codes_of(raw)
            first = np.cumsum(lens) - lens
            base = np.add.reduceat(np.log10((by_number + 0.5) / space)[codes], first)
            known = np.add.reduceat((by_number > 0).astype(np.int64)[codes], first)
            ids, learn, scores = zip(*(p.split(",") for p in payload))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([int(i) if i else None for i in ids], pa.int64()),
                    pa.array([flag != "true" for flag in learn]),
                    pa.array(lens, pa.int64()),
                    pa.array(known),
                    pa.array([total] * len(lens), pa.int64()),
                    pa.array(base),
                    pa.array([float(s) for s in scores]),
                ],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )


def is_held_out(id_col: str) -> Column:
    """crc32 of the id as text leaves 1 when divided by five; a null id is learned from."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 1


def score_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of `df`.

    `score` is the log10 probability of the whole text and its end under PPM, `base_score` that of its words
    under smoothed counts; both learn from the rows that are not held out. A null text is empty: it has one
    token, its end. Repeated rows each give a row and are each learned from; other columns are not read.
    An empty table gives no rows; if every row is held out, the model knows nothing and all bytes are alike.
    """
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), (~is_held_out(id_col)).alias("learn"))
    model = train(rows.where("learn"))
    scored = score(rows, model)
    payload = F.concat_ws(",", F.coalesce(F.col("id").cast("string"), F.lit("")), "learn", "score").alias("payload")
    stored = blocks.store_blocks(scored.select(payload, "text", "learn"), _tokens)
    packs = cut(blocks.words_of(stored).mapInArrow(_look_up, f"{blocks.PACK}, distinct long, total long"))
    distinct, total = packs.agg(F.coalesce(F.sum("distinct"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0))).head()
    result = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return blocks.join_back(stored, packs).mapInArrow(partial(_assemble, total, distinct), result)

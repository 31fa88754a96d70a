"""Passages repeated across documents, by a sparse suffix array.

A full suffix array has an entry for every word. Here only the suffixes at content-selected positions are
kept: of every `WINDOW` successive grams of `GRAM` words the one with the smallest hash (a minimiser). The
same words select the same positions wherever they stand, and a passage of WINDOW + GRAM - 1 = `PASSAGE`
words holds at least one, about one position in sixteen in all.

1. Grams that were selected only once in the corpus start no repeat; they are counted away first.
2. The other suffixes are sorted by gram and by the words after it, over all partitions of a range sort, and
   compared with their neighbours: suffixes with the longest common continuation stand next to each other.
   The match is extended to the right, and to the left, up to WINDOW - 1 words on either side; what is longer
   goes on at the next selected position. A second array, sorted by the words before the gram, finds
   neighbours with the longest common past.
3. Where one neighbour shares the words before the gram and another those after it, the stretches of PASSAGE
   words that may still be repeats are grouped by their words.
4. Matches of PASSAGE words or more are united to the passages of their document.

A text that repeats a few words on and on selects equal grams on and on; those with the same words around them
are one suffix with the distance to the last of them. Equal suffixes of a thousand copies are a thousand
neighbours, not a million pairs. Neighbours on either side of a partition's border are compared in one more,
small, step: a run or two per partition.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendspark.llm.common import cut, lean
from lendspark.operators.skew import lookup, small

GRAM = 20
WINDOW = 31
PASSAGE = GRAM + WINDOW - 1
SIDE = WINDOW - 1
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2 ** 64
_INVERSE = pow(_BASE, -1, 1 << 64)
_ROWS_AT_ONCE = 1 << 16
_WORDS_KEPT = 1 << 20

_SUFFIX = "gram long, right binary, left binary, rlen int, llen int, id long, key long, at int, more int"
_FOUND = f"{_SUFFIX}, begin int, end int, other long, after int, before int, cover long, border boolean"


class _Hashes(dict):
    """XXH64 of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _WORDS_KEPT:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


class _Powers:
    """Powers of the base and of its inverse, as far as the longest text needs them."""

    def __init__(self):
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def get(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < size:
            length = 1 << size.bit_length()
            factors = (np.full(length, value, dtype=np.uint64) for value in (_BASE, _INVERSE))
            self.up, self.down = (self._from_one(f) for f in factors)
        return self.up[:size], self.down[:size]

    @staticmethod
    def _from_one(factors: np.ndarray) -> np.ndarray:
        factors[0] = 1
        return np.multiply.accumulate(factors)


def _selected(words: np.ndarray, powers: _Powers) -> tuple[np.ndarray, np.ndarray]:
    """(positions, grams) of the minimisers of a text's word hashes."""
    if len(words) < PASSAGE:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
    up, down = powers.get(len(words))
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(words * up, dtype=np.uint64)])
    grams = (sums[GRAM:] - sums[:-GRAM]) * down[: len(words) - GRAM + 1]
    grams ^= grams >> np.uint64(33)
    grams *= np.uint64(0xFF51AFD7ED558CCD)
    grams ^= grams >> np.uint64(33)
    windows = np.lib.stride_tricks.sliding_window_view(grams, WINDOW)
    places = np.unique(windows.argmin(axis=1) + np.arange(len(windows)))
    return places, grams[places]


def _texts(column: pa.Array) -> Iterator[list[bytes]]:
    for value in pc.cast(column, pa.binary()):
        yield (value.as_py() or b"").split()


@lean
def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes, powers = _Hashes(), _Powers()
    for batch in batches:
        rows, grams = [], []
        for row, words in enumerate(_texts(batch.column(2))):
            if len(words) >= PASSAGE:
                found = np.unique(_selected(np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words)), powers)[1])
                rows.append(np.full(len(found), row))
                grams.append(found)
        if rows:
            taken = batch.select([0, 1]).take(pa.array(np.concatenate(rows)))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(grams).view(np.int64)), *taken.columns], names=["gram", "id", "key"])


def _sides(words: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words after the gram and before it (nearest first) as rows of SIDE numbers, and how many there are."""
    padded = np.concatenate([np.zeros(SIDE, dtype=np.uint32), words, np.zeros(SIDE, dtype=np.uint32)])
    steps = np.arange(SIDE)
    right = padded[(places + GRAM + SIDE)[:, None] + steps]
    left = padded[(places + SIDE - 1)[:, None] - steps]
    return right, left, np.minimum(len(words) - places - GRAM, SIDE), np.minimum(places, SIDE)


def _chains(words: np.ndarray, places: np.ndarray, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which places to keep, how far the last place of each one's chain lies behind it).

    A chain is a series of places of one gram, no further apart than a passage, with the same words on both sides: in
    a text that repeats a few words on and on, nearly all places. What matches one of them matches all, at the same distance.
    """
    order = np.lexsort((places, grams))
    at, gram = places[order], grams[order]
    same = np.zeros(len(order), dtype=bool)
    same[1:] = (gram[1:] == gram[:-1]) & (at[1:] - at[:-1] <= PASSAGE)
    whole = (at >= SIDE) & (at + GRAM + SIDE <= len(words))
    same[1:] &= whole[1:] & whole[:-1]
    asked = np.flatnonzero(same)
    if len(asked):
        around = np.lib.stride_tricks.sliding_window_view(words, GRAM + 2 * SIDE)
        for begin in range(0, len(asked), _ROWS_AT_ONCE):
            part = asked[begin : begin + _ROWS_AT_ONCE]
            same[part] = (around[at[part] - SIDE] == around[at[part - 1] - SIDE]).all(axis=1)
    first = np.flatnonzero(~same)
    last = np.append(first[1:], len(order)) - 1
    by_place = np.argsort(at[first], kind="stable")
    return order[first][by_place], (at[last] - at[first])[by_place]


@lean
def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes, powers = _Hashes(), _Powers()
    for batch in batches:
        parts = []
        for row, (words, wanted) in enumerate(zip(_texts(batch.column(2)), batch.column(3))):
            full = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
            places, grams = _selected(full, powers)
            own = np.isin(grams, wanted.values.to_numpy().view(np.uint64))
            places, grams = places[own], grams[own]
            short = (full >> np.uint64(32)).astype(np.uint32)
            kept, more = _chains(short, places, grams)
            places, grams = places[kept], grams[kept]
            parts.append((grams, *_sides(short, places), np.full(len(places), row), places, more))
        if not parts:
            continue
        grams, right, left, rlen, llen, row, places, more = (np.concatenate(x) for x in zip(*parts))
        taken = batch.select([0, 1]).take(pa.array(row))
        columns = [pa.array(grams.view(np.int64)), _blobs(right), _blobs(left), pa.array(rlen.astype(np.int32)), pa.array(llen.astype(np.int32))]
        yield pa.RecordBatch.from_arrays([*columns, *taken.columns, *(pa.array(x.astype(np.int32)) for x in (places, more))], names=[c.split()[0] for c in _SUFFIX.split(", ")])


def _blobs(rows: np.ndarray) -> pa.Array:
    width = rows.shape[1] * rows.itemsize
    offsets = pa.py_buffer((np.arange(len(rows) + 1) * width).astype(np.int32).tobytes())
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, offsets, pa.py_buffer(rows.tobytes())])


def _numbers(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint32).reshape(-1, SIDE)


def _common(numbers: np.ndarray, lens: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many words two suffixes share on one side of their gram."""
    same = numbers[a] == numbers[b]
    length = np.where(same.all(axis=1), SIDE, same.argmin(axis=1))
    return np.minimum(length, np.minimum(lens[a], lens[b]))


@lean
def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compare every suffix with the nearest ones of other documents before and after it in sorted order."""

    def runs_of(rows: pa.Table) -> np.ndarray:
        change = np.ones(rows.num_rows, dtype=bool)
        change[1:] = False
        for name in ("gram", "id", "key"):
            column = rows.column(name).combine_chunks()
            values, known = pc.fill_null(column, 0).to_numpy(), column.is_valid().to_numpy(zero_copy_only=False)
            change[1:] |= (values[1:] != values[:-1]) | (known[1:] != known[:-1])
        return np.flatnonzero(change)

    def results(rows: pa.Table, starts: np.ndarray, begin: int, end: int, borders: list[tuple[int, int]]) -> pa.RecordBatch:
        gram, at, more, rlen, llen = (rows.column(c).to_numpy() for c in ("gram", "at", "more", "rlen", "llen"))
        ids = rows.column("id").to_pandas(integer_object_nulls=True).to_numpy(dtype=object)
        right, left = _numbers(rows.column("right")), _numbers(rows.column("left"))
        run = np.searchsorted(starts, np.arange(begin, end), side="right") - 1
        ends = np.append(starts[1:], rows.num_rows)
        low = np.full(rows.num_rows, np.iinfo(np.int32).max, dtype=np.int64)
        high = np.full(rows.num_rows, -1, dtype=np.int64)
        other: list = [None] * rows.num_rows
        most = np.zeros((2, rows.num_rows), dtype=np.int64)  # words shared after and before
        cover = np.zeros(rows.num_rows, dtype=np.int64)  # bit s: the words from s before the gram on are a match
        for near in (starts[run] - 1, ends[run]):
            mine = np.arange(begin, end)
            valid = (near >= 0) & (near < rows.num_rows)
            mine, near = mine[valid], near[valid]
            equal = gram[mine] == gram[near]
            mine, near = mine[equal], near[equal]
            after, before = _common(right, rlen, mine, near), _common(left, llen, mine, near)
            most[0, mine], most[1, mine] = np.maximum(most[0, mine], after), np.maximum(most[1, mine], before)
            long = before + GRAM + after >= PASSAGE
            mine, near, after, before = mine[long], near[long], after[long], before[long]
            cover[mine] |= (1 << (before + 1)) - (1 << (SIDE - after))
            low[mine] = np.minimum(low[mine], at[mine] - before)
            high[mine] = np.maximum(high[mine], at[mine] + more[mine] + GRAM + after)
            for i, j in zip(mine, near):
                if ids[j] is not None and (other[i] is None or ids[j] < other[i]):
                    other[i] = int(ids[j])
        hit = np.flatnonzero(most.any(axis=0) | (high >= 0))
        edge = np.concatenate([np.arange(a, b) for a, b in borders]).astype(np.int64) if borders else np.empty(0, dtype=np.int64)
        taken = rows.take(pa.array(np.concatenate([hit, edge]))).combine_chunks()
        border = np.concatenate([np.zeros(len(hit), dtype=bool), np.ones(len(edge), dtype=bool)])
        columns = [c.combine_chunks() for c in taken.columns]
        for i in (1, 2):  # words are only needed again at a border
            columns[i] = pc.if_else(pa.array(border), columns[i], pa.scalar(None, pa.binary()))
        both = np.concatenate([hit, edge])
        columns += [pa.array(low[both].astype(np.int32)), pa.array(high[both].astype(np.int32)), pa.array([other[i] for i in both], pa.int64())]
        columns += [*(pa.array(m[both].astype(np.int32)) for m in most), pa.array(cover[both]), pa.array(border)]
        return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _FOUND.split(", ")])

    held: list[pa.RecordBatch] = []
    size = context = 0
    first = True
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size < _ROWS_AT_ONCE:
            continue
        rows = pa.Table.from_batches(held)
        starts = runs_of(rows)
        last = int(starts[-1])
        if last > context:
            yield results(rows, starts, context, last, [(0, int(starts[1]))] if first else [])
            first = False
            # The last run waits for what follows it, beside the row before it.
            held, context = rows.slice(last - 1).to_batches(), 1
            size = rows.num_rows - last + 1
        else:
            held, size = rows.to_batches(), 0  # one long run: wait for as many rows again
    rows = pa.Table.from_batches(held) if held else None
    if rows is not None and rows.num_rows > context:
        starts = runs_of(rows)
        borders = [(int(starts[-1]), rows.num_rows)]
        if first and len(starts) > 1:
            borders.append((0, int(starts[1])))
        yield results(rows, starts, context, rows.num_rows, borders)


def _matches(suffixes: DataFrame, order: list[str]) -> DataFrame:
    """What the suffixes that share a word beside their gram have in common with a neighbour in one sorted array;
    `end` is negative without a match."""
    ranged = suffixes.repartitionByRange(*order).sortWithinPartitions(*order)
    found = cut(ranged.mapInArrow(_compare, _FOUND))
    names = [c.split()[0] for c in _SUFFIX.split(", ")]
    borders = found.where("border").select(*names).distinct().coalesce(1).sortWithinPartitions(*order)
    across = cut(borders.mapInArrow(_compare, _FOUND))
    wanted = ("gram", "id", "key", "at", "begin", "end", "other", "after", "before", "cover")
    return found.where("not border").select(*wanted).unionByName(across.where("not border").select(*wanted))


def _crossed(suffixes: DataFrame, near: DataFrame) -> DataFrame:
    """(id, key, begin, end, other) of the passages whose words no neighbour shares whole.

    One neighbour may share the words after a gram and another those before it, and a third document both. What
    the neighbours share is the most that any document shares on that side, so only stretches of PASSAGE words
    within it can be repeats. Those that no neighbour settled are asked for by their words, in all suffixes of the gram.
    """
    open_ = F.expr(f"(shiftleft(1L, before + 1) - shiftleft(1L, {SIDE} - after)) & ~cover")
    asked = (
        near.groupBy("gram", "id", "key", "at")
        .agg(F.max("after").alias("after"), F.max("before").alias("before"), F.bit_or("cover").alias("cover"))
        .where(F.col("after") + F.col("before") >= SIDE)
        .select("gram", open_.alias("asked"))
        .where("asked != 0")
        .groupBy("gram")
        .agg(F.bit_or("asked").alias("asked"))
    )
    steps = F.expr(f"explode(filter(sequence(0, {SIDE}), s -> (shiftleft(1L, s) & asked) != 0 AND s <= llen AND {SIDE} - s <= rlen)) AS s")
    words = F.expr(f"xxhash64(substring(`left`, 1, 4 * s), substring(`right`, 1, 4 * ({SIDE} - s))) AS words")
    stretches = suffixes.join(small(asked), "gram").select("gram", "id", "key", "at", "more", "left", "right", steps)
    stretches = cut(stretches.select("gram", "s", words, "id", "key", "at", "more"))
    doc = F.struct("id", "key")
    repeated = stretches.groupBy("gram", "s", "words").agg(F.min(doc).alias("low"), F.max(doc).alias("high")).where("NOT low <=> high")
    other = F.coalesce(F.when(~doc.eqNullSafe(F.col("low")), F.col("low.id")), F.when(~doc.eqNullSafe(F.col("high")), F.col("high.id")))
    begin = F.col("at") - F.col("s")
    return lookup(stretches, repeated, ["gram", "s", "words"]).select(
        "id", "key", begin.alias("begin"), (begin + PASSAGE + F.col("more")).alias("end"), other.alias("other")
    )


def _unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, begins, ends, others = [], [], [], []
        for row, spans in enumerate(batch.column(1).to_pylist()):
            last = None
            for span in sorted(spans, key=lambda s: (s["begin"], s["end"])):
                if last and span["begin"] <= last[1]:
                    last[1] = max(last[1], span["end"])
                    known = [o for o in (last[2], span["other"]) if o is not None]
                    last[2] = min(known, default=None)
                else:
                    last = [span["begin"], span["end"], span["other"]]
                    ids.append(row)
                    begins.append(last)
        taken = batch.column(0).take(pa.array(ids, pa.int64()))
        columns = [pa.array([b[i] for b in begins], kind) for i, kind in ((0, pa.int32()), (1, pa.int32()), (2, pa.int64()))]
        yield pa.RecordBatch.from_arrays([taken, *columns], names=["doc_id", "begin", "end", "other_id"])


def repeated_passages(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, begin, end, other_id): the passages of at least PASSAGE words that another document has as well.

    One row per maximal stretch of words of a document (`begin` inclusive, `end` exclusive, counted from 0)
    that matches cover; `other_id` is the smallest id among the neighbours it matched. Words are split at
    blanks and compared as they are. A document does not repeat itself: rows that share an id and a text are
    one document. A null, empty or short text has no passages. Rows with a null id are compared like others.
    Other columns are not read; an empty table gives no rows.
    """
    text = F.col(text_col)
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("key"), text.alias("text"))
    grams = cut(docs.mapInArrow(_grams, "gram long, id long, key long"))
    repeated = grams.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram")
    wanted = lookup(grams, repeated, ["gram"]).groupBy("id", "key").agg(F.collect_set("gram").alias("grams"))
    wanted = wanted.select(F.col("id").alias("_id"), F.col("key").alias("_key"), "grams")
    candidates = docs.join(wanted, F.col("id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key")))
    suffixes = cut(candidates.select("id", "key", "text", "grams").mapInArrow(_suffixes, _SUFFIX))
    after = _matches(suffixes, ["gram", "right", "left", "id", "key", "at"])
    before = _matches(suffixes, ["gram", "left", "right", "id", "key", "at"])
    near = after.unionByName(before)
    matched = near.where("end >= 0").select("id", "key", "begin", "end", "other")
    spans = matched.unionByName(_crossed(suffixes, near)).groupBy("id", "key").agg(F.collect_list(F.struct("begin", "end", "other")).alias("spans"))
    return spans.select("id", "spans").mapInArrow(_unite, "doc_id long, begin int, end int, other_id long")

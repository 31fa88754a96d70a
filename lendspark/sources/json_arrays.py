"""JSON arrays of any size, read by many tasks: one row per element, whatever the file's layout.

A byte in the middle of a file does not tell whether it stands in a string, or how deep. But what a stretch
of bytes does to that state can be worked out for either answer, and such effects can be chained:

1. Every task cuts its splits into chunks of about `CHUNK` bytes and notes for each of them the state at its start
   and end, for both cases of the split: beginning outside a string, or inside. The chunks are stored.
2. The effects of the splits, one narrow row each, are chained file by file, which gives the state in which each
   split really begins.
3. Every chunk is cut at the commas between elements. Whole elements are done; the ends are put together
   with those of the neighbouring chunks.

Splits come from Spark's text source, with the closing brace as the end of a line: every record has one, so lines are never
longer than a record. No file is opened by name, so any store that Spark reads will do.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lendspark.operators.skew import small
from lendspark.session import cut

CHUNK = 1 << 20
SPLITS_SENT = 1_000_000  # rows of some 40 bytes; more splits than that are joined
_BRACE, _QUOTE, _ESCAPE, _COMMA = b'}"\\,'
_BLANK = b" \t\r\n\xef\xbb\xbf"
_LINES = "file long, block long, line binary"
_CHUNKS = (
    "file long, block long, chunk long, data binary, first string,"
    " inside_0 boolean, inside_1 boolean, depth_0 long, depth_1 long, end_0 boolean, end_1 boolean, deep_0 long, deep_1 long"
)
RECORDS = "line string, name string, size bigint, modified timestamp, position struct<block:bigint,row:bigint>"


def _tokens(data: np.ndarray, inside: bool) -> tuple[np.ndarray, np.ndarray]:
    """(depth change of every byte, whether it is outside strings), if the first byte is inside a string or not."""
    at = np.arange(len(data))
    slash = data == _ESCAPE
    run = at - np.maximum.accumulate(np.where(slash, -1, at))  # backslashes in a row that end here
    escaped = np.zeros(len(data), dtype=bool)
    escaped[1:] = (run[:-1] & 1) == 1
    quotes = np.cumsum((data == _QUOTE) & ~escaped) + int(inside)
    outside = (quotes & 1) == 0  # a closing quote counts as outside, an opening one as inside: neither is a bracket
    opens = (data == ord("{")) | (data == ord("["))
    closes = (data == ord("}")) | (data == ord("]"))
    return (opens.astype(np.int64) - closes) * outside, outside


def _effect(data: bytes, inside: bool, depth: int) -> tuple[bool, int]:
    """The state after `data`. A chunk never ends in a backslash, as it ends with a brace."""
    change, outside = _tokens(np.frombuffer(data, dtype=np.uint8), inside)
    return not outside[-1], depth + int(change.sum())


def _chunks(limit: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines of each split, put together again in chunks with the state before and after them."""
    place, number, state, held, size = None, 0, [(False, 0), (True, 0)], [], 0

    def row() -> pa.RecordBatch:
        nonlocal number, state, held, size
        data = b"".join(held)
        after = [_effect(data, *s) for s in state]
        columns = [[place[0]], [place[1]], [number], [data], [data.strip(_BLANK)[:2].decode("latin-1")]]
        columns += [[s[i]] for i in (0, 1) for s in state] + [[s[i]] for i in (0, 1) for s in after]
        number, state, held, size = number + 1, after, [], 0
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[c.split()[0] for c in _CHUNKS.split(",")])

    for batch in batches:
        for file, block, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            if (file, block) != place or size >= limit:
                if held:
                    yield row()
                if (file, block) != place:
                    place, number, state = (file, block), 0, [(False, 0), (True, 0)]
            held += [line, b"}"]
            size += len(line) + 1
    if held:
        yield row()


def _starts(splits: pd.DataFrame) -> pd.DataFrame:
    """The state in which each split of one file begins, and whether the last brace of the file was never there."""
    splits = splits.sort_values("block")
    inside, depth, found = False, 0, []
    for split in splits.itertuples():
        found.append((inside, depth))
        inside, depth = (split.end_1, depth + split.deep_1) if inside else (split.end_0, depth + split.deep_0)
    kinds = [x for x in splits["first"] if x]
    # With the brace that was put after the file's end, there is one byte too many; a byte order mark is left out by the reader.
    padded = int(splits["bytes"].sum()) - int(splits["size"].iloc[0]) in (1, 1 - 3)
    blank = padded and kinds == ["}"] and splits["chunks"].sum() == 1  # the brace that was never there, and nothing else
    out = splits[["file", "block"]].copy()
    out["inside"], out["depth"] = [s[0] for s in found], [s[1] for s in found]
    out["is_array"] = blank or (bool(kinds) and kinds[0][0] == "[")
    out["last"] = [*[-1] * (len(splits) - 1), int(splits["chunks"].iloc[-1]) - 1]
    out["padded"] = padded
    return out


_PIECES = "file long, block long, chunk long, row long, text binary, opens boolean, closes boolean"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The elements of each chunk, and what stands before the first and after the last border in it."""
    for batch in batches:
        for row in batch.to_pylist():
            data = row["data"][:-1] if row["padded"] and row["chunk"] == row["last"] else row["data"]
            which = int(row["inside"])
            change, outside = _tokens(np.frombuffer(data, dtype=np.uint8), row[f"inside_{which}"])
            depth = np.cumsum(change) + row["depth"] + row[f"depth_{which}"]
            buffer = np.frombuffer(data, dtype=np.uint8)
            border = ((buffer == _COMMA) & outside & (depth == 1)) | ((change > 0) & (depth == 1)) | ((change < 0) & (depth == 0))
            at = np.flatnonzero(border).tolist()
            edges = [-1, *at, len(data)]
            texts = [data[a + 1 : b] for a, b in zip(edges, edges[1:])]
            count = len(texts)
            columns = [
                [row["file"]] * count, [row["block"]] * count, [row["chunk"]] * count, list(range(count)), texts,
                [i > 0 for i in range(count)], [i < count - 1 for i in range(count)],
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[c.split()[0] for c in _PIECES.split(", ")])


def scan_array_elements(spark: SparkSession, path: str, pattern: str = "*.json", larger_than: int = -1) -> DataFrame:
    """(line, name, size, modified, position) of every element of the JSON arrays in a folder.

    `line` is the element's text, as `scan_lines` gives it for feeds with one record per line. A file that is no array gives
    one null line; of a file that is cut off, the whole elements are given, and the rest as a line that is no JSON.
    An empty array gives none. `larger_than` leaves out files of up to so many bytes.
    """
    meta = F.col("_metadata")
    try:
        text = spark.read.option("pathGlobFilter", pattern).option("lineSep", "}").text(path)
    except AnalysisException as error:
        if not (error.getCondition() or "").startswith("PATH_NOT_FOUND"):
            raise
        return spark.createDataFrame([], RECORDS)
    text = text.where(meta["file_size"] > larger_than)
    file = F.xxhash64(meta["file_path"]).alias("file")
    lines = text.select(file, meta["file_block_start"].alias("block"), F.col("value").cast("binary").alias("line"))
    chunks = cut(lines.mapInArrow(partial(_chunks, CHUNK), _CHUNKS))

    # One row per file; the text itself is not read for these columns.
    files = cut(
        text.select(file, meta["file_name"].alias("name"), meta["file_size"].alias("size"), meta["file_modification_time"].alias("modified")).distinct()
    )
    ends = F.struct(*[f"{x}_{i}" for x in ("end", "deep") for i in (0, 1)])
    splits = chunks.groupBy("file", "block").agg(
        F.max_by(ends, "chunk").alias("e"),
        F.min_by("first", F.when(F.col("first") != "", F.col("chunk"))).alias("first"),
        F.count("*").alias("chunks"),
        F.sum(F.length("data")).alias("bytes"),
    )
    splits = splits.join(small(files.select("file", "size")), "file").select("file", "block", "e.*", F.coalesce("first", F.lit("")).alias("first"), "chunks", "bytes", "size")
    starts = cut(
        splits.groupBy("file").applyInPandas(
            _starts, "file long, block long, inside boolean, depth long, is_array boolean, last long, padded boolean"
        )
    )

    states = small(starts.where("is_array").drop("is_array"), SPLITS_SENT)
    placed = chunks.join(states, ["file", "block"])
    pieces = cut(placed.mapInArrow(_cut, _PIECES))
    done = pieces.where("opens AND closes").select("file", "block", "chunk", "row", "text", F.lit(True).alias("closed"))
    # What is left are the two ends of every chunk: a piece that opens is followed by those that do not.
    along = Window.partitionBy("file").orderBy("block", "chunk", "row")
    numbered = pieces.where("NOT (opens AND closes)").withColumn("element", F.sum(F.col("opens").cast("long")).over(along))
    parts = F.array_sort(F.collect_list(F.struct("block", "chunk", "row", "text", "closes")))  # as long as one element
    joined = numbered.where("element > 0").groupBy("file", "element").agg(parts.alias("parts")).select(
        "file", F.col("parts")[0]["block"].alias("block"), F.col("parts")[0]["chunk"].alias("chunk"), F.col("parts")[0]["row"].alias("row"),
        F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["text"])).alias("text"),
        F.exists("parts", lambda p: p["closes"]).alias("closed"),
    )
    found = done.unionByName(joined).withColumn("line", F.decode("text", "UTF-8"))
    # Blank is what follows the closing bracket, and the inside of an empty array.
    kept = found.where(F.trim(F.translate("line", "\t\r\n", "   ")) != "")
    nothing = starts.where("NOT is_array").select("file").distinct().select(
        "file", F.lit(None).cast("string").alias("line"), F.lit(0).cast("long").alias("block"), F.lit(0).cast("long").alias("row")
    )
    order = F.col("chunk") * F.lit(CHUNK * 4) + F.col("row")  # fewer elements in a chunk than bytes
    rows = kept.select("file", "line", "block", order.alias("row")).unionByName(nothing)
    return rows.join(small(files), "file").select("line", "name", "size", "modified", F.struct("block", "row").alias("position"))

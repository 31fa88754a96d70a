"""Byte-level BPE: encoding by a global shuffle of distinct words, decoding by the token-byte table.

Texts are cut into pre-tokens by the tokenizer's pattern. The pre-tokens of a block of documents keep their
positions as codes (see `blocks`), the distinct ones are shuffled by word over the whole corpus, each is
encoded once, and the ids go back to the blocks, where documents are put together by position. Decoding
looks every id up in the table of token bytes: it has one entry per token of the vocabulary, so its size is
that of the rank file, and it goes to every executor.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendspark.llm import blocks
from lendspark.llm.common import lean

_TOKENS_AT_ONCE = 1 << 19


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a token in base64 and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


@lru_cache(maxsize=4)
def _encoder(ranks, pattern: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("given", pat_str=pattern, mergeable_ranks=ranks.value, special_tokens={})


@lru_cache(maxsize=4)
def _splitter(pattern: str):
    return regex.compile(pattern)


def _split(pattern: str, text: bytes) -> list[bytes]:
    return [piece.encode() for piece in _splitter(pattern).findall(text.decode("utf-8", "replace"))]


@lean
def _encode(ranks, pattern: str, kind, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    encode = _encoder(ranks, pattern).encode_ordinary
    for rows, first in blocks.whole_words(batches):
        words = rows.column(0).combine_chunks().take(pa.array(first)).to_pylist()
        ids = [encode(word.decode()) for word in words]
        sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        flat = np.fromiter((i for part in ids for i in part), dtype=kind, count=int(sizes.sum()))
        times = np.diff([*first, rows.num_rows])
        start = np.repeat(np.cumsum(sizes) - sizes, times)
        size = np.repeat(sizes, times)
        yield blocks.packed(rows.column(1).to_numpy(), size, flat[blocks.gather(start, size)])


@lean
def _assemble(kind, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            payload, lens, raw, packs = (batch.column(i)[row].as_py() for i in range(4))
            start, size, values = blocks.looked_up(packs, kind)
            codes = blocks.codes_of(raw)
            ends = np.cumsum(lens)
            begin = 0
            while begin < len(lens):  # a few documents at a time: ids take more room than codes
                base = ends[begin - 1] if begin else 0
                stop = max(begin + 1, int(np.searchsorted(ends, base + _TOKENS_AT_ONCE, side="right")))
                part = codes[base : ends[stop - 1]]
                ids = values[blocks.gather(start[part], size[part])].astype(np.int32)
                counts = np.concatenate([[0], np.cumsum(size[part])])
                offsets = counts[np.concatenate([[0], ends[begin:stop] - base])].astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))
                yield pa.RecordBatch.from_arrays([pa.array(payload[begin:stop], pa.string()), lists], names=["id", "ids"])
                begin = stop


def encode(df: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids) for every row of `df`: the token ids of the whole text, none for a null or empty one.

    Special tokens are ordinary text. Repeated rows each give a row, null ids stay null; other columns are
    not read. An empty table gives no rows.
    """
    shared = df.sparkSession.sparkContext.broadcast(ranks)
    kind = np.uint16 if max(ranks.values(), default=0) < 1 << 16 else np.uint32
    texts = df.select(F.col(id_col).cast("string").alias("payload"), F.col(text_col).alias("text"), F.lit(False).alias("learn"))
    stored = blocks.store_blocks(texts, partial(_split, pattern))
    packs = blocks.words_of(stored).drop("count").mapInArrow(partial(_encode, shared, pattern, kind), blocks.PACK)
    whole = blocks.join_back(stored, packs).mapInArrow(partial(_assemble, kind), "id string, ids array<int>")
    return whole.select(F.col("id").cast("long").alias("doc_id"), "ids")


def token_table(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, size, bytes) of every token by its id; ids without a token have no bytes."""
    size = np.zeros(max(ranks.values(), default=-1) + 1, dtype=np.int64)
    for token, rank in ranks.items():
        size[rank] = len(token)
    data = b"".join(sorted(ranks, key=ranks.get))
    return np.cumsum(size) - size, size, np.frombuffer(data, dtype=np.uint8)


@lean
def _decode(shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    start, size, data = shared.value
    for batch in batches:
        lists = batch.column(1)
        texts = []
        for row in range(batch.num_rows):
            ids = lists[row].values
            ids = ids.to_numpy() if ids is not None else np.empty(0, dtype=np.int32)
            texts.append(data[blocks.gather(start[ids], size[ids])].tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), lists, pa.array(texts, pa.binary())], names=["doc_id", "ids", "bytes"])


def decode(df: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """(doc_id, ids, bytes) from (doc_id, ids): the bytes that each list of ids stands for; null ids are none."""
    shared = df.sparkSession.sparkContext.broadcast(token_table(ranks))
    return df.select("doc_id", "ids").mapInArrow(partial(_decode, shared), "doc_id long, ids array<int>, bytes binary")


def _ids_digest() -> Column:
    return F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256)


def round_trip(df: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every document encoded and decoded again.

    A null text is an empty one: no tokens, and the digests of nothing. Repeated rows and rows without an id each give a row; other
    columns are not read; an empty table gives no rows.
    """
    decoded = decode(encode(df, ranks, pattern), ranks)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        _ids_digest().alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


def public_tokenizer(spark: SparkSession) -> tuple[dict[bytes, int], str]:
    """Ranks and pattern of the multilingual public tokenizer installed beside Spark."""
    import public_tokenizers

    return read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN

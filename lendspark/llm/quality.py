"""A quality classifier: a generalised additive model with pairwise interactions.

Every feature is cut into bins at its quantiles. Cyclic boosting fits one shallow tree at a time, on one
feature's bins in turn, to the gradient of the logistic loss; as each tree sees a single feature, the trees
of a feature add up to one lookup table. The pairs of features with the largest gain on what is left get
tables over two coarser bins in the same way, from trees with one cut on either feature. A score is then
the sum of one table entry per feature and per pair, added up for a whole Arrow batch at once.

Features are taken from the text alone. The model is fitted on at most `SAMPLE` labelled rows, chosen by
the hash of their id; this bound is a parameter, and everything else covers all rows. Scoring is one pass
over the texts, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendspark.llm.common import lean

SAMPLE = 20_000
THRESHOLD = 0.3
BINS = 32
PAIR_BINS = 8
PAIRS = 6
ROUNDS = 80
PAIR_ROUNDS = 40
RATE = 0.15
RIDGE = 1.0

FEATURES = (
    "words", "word_length", "capitals", "digits", "marks", "marked_ends", "odd_marks", "distinct", "echoes",
    "lines", "repeated_lines", "single_marks", "non_ascii",
)

# Byte classes: 1 capital, 2 small letter, 3 digit, 4 usual mark, 5 other ASCII mark, 6 blank, 7 non-ASCII.
_CLASS = np.zeros(256, dtype=np.uint8)
_CLASS[33:127] = 5
for _chars, _number in ((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", 1), (b"abcdefghijklmnopqrstuvwxyz", 2), (b"0123456789", 3), (b".,;:'\"()-?!", 4), (b" \t\n\x0b\x0c\r", 6)):
    _CLASS[list(_chars)] = _number
_CLASS[128:] = 7
_MARK = _CLASS[:128] >= 4


def features(text: bytes) -> tuple[float, ...]:
    """The features of one text, in the order of FEATURES; all zero for an empty one."""
    words = text.split()
    if not words:
        return (0.0,) * len(FEATURES)
    count = len(words)
    kinds = np.bincount(_CLASS[np.frombuffer(text, dtype=np.uint8)], minlength=8)
    shown = max(1, len(text) - int(kinds[6]))
    letters = max(1, int(kinds[1] + kinds[2]))
    lines = text.split(b"\n")
    return (
        float(np.log1p(count)),
        shown / count,
        kinds[1] / letters,
        kinds[3] / shown,
        kinds[4] / shown,
        sum(1 for w in words if w[-1] < 128 and _MARK[w[-1]]) / count,
        kinds[5] / shown,
        len(set(words[:])) / count**0.8,
        sum(1 for a, b in zip(words, words[1:]) if a == b) / count,
        len(lines) / count,
        1.0 - len(set(lines)) / len(lines),
        sum(1 for w in words if len(w) == 1 and w[0] < 128 and _MARK[w[0]]) / count,
        kinds[7] / shown,
    )


def _feature_rows(column: pa.Array) -> np.ndarray:
    texts = pc.cast(column, pa.binary())
    return np.array([features(t.as_py() or b"") for t in texts], dtype=np.float64).reshape(len(texts), len(FEATURES))


@dataclass
class Model:
    """Lookup tables: `tables[f]` by a feature's bin, `pair_tables[i]` by two coarse bins of `pairs[i]`."""

    base: float
    cuts: list[np.ndarray]
    tables: np.ndarray
    pair_cuts: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: np.ndarray

    def score(self, values: np.ndarray) -> np.ndarray:
        """Probability of label 1 for rows of feature values."""
        total = np.full(len(values), self.base)
        coarse = [np.searchsorted(c, values[:, f], side="right") for f, c in enumerate(self.pair_cuts)]
        for f, cuts in enumerate(self.cuts):
            total += self.tables[f][np.searchsorted(cuts, values[:, f], side="right")]
        for (f, g), lookup in zip(self.pairs, self.pair_tables):
            total += lookup[coarse[f], coarse[g]]
        return 1.0 / (1.0 + np.exp(-total))


def _quantiles(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.arange(1, bins) / bins)) if len(values) else np.empty(0)


def _leaf(gradient, hessian):
    return gradient / (hessian + RIDGE)


def _gain(gradient, hessian):
    return gradient * gradient / (hessian + RIDGE)


def _tree(gradient: np.ndarray, hessian: np.ndarray, depth: int = 2) -> np.ndarray:
    """Leaf values per bin of the best tree of that depth on one feature's histogram."""
    if depth and len(gradient) > 1:
        left_g, left_h = np.cumsum(gradient)[:-1], np.cumsum(hessian)[:-1]
        all_g, all_h = gradient.sum(), hessian.sum()
        gains = _gain(left_g, left_h) + _gain(all_g - left_g, all_h - left_h) - _gain(all_g, all_h)
        cut = int(np.argmax(gains)) + 1
        if gains[cut - 1] > 1e-9:
            parts = (slice(None, cut), slice(cut, None))
            return np.concatenate([_tree(gradient[p], hessian[p], depth - 1) for p in parts])
    return np.full(len(gradient), _leaf(gradient.sum(), hessian.sum()))


def _pair_tree(gradient: np.ndarray, hessian: np.ndarray) -> tuple[float, np.ndarray]:
    """(gain, leaf values) of the best tree with one cut on either feature of a two-way histogram."""
    g, h = gradient.cumsum(0).cumsum(1), hessian.cumsum(0).cumsum(1)

    def corners(c):
        low = c[:-1, :-1]
        right, down = c[:-1, -1:] - low, c[-1:, :-1] - low
        return low, right, down, c[-1, -1] - low - right - down

    quarters = list(zip(corners(g), corners(h)))
    gains = sum(_gain(a, b) for a, b in quarters) - _gain(g[-1, -1], h[-1, -1])
    i, j = np.unravel_index(int(np.argmax(gains)), gains.shape)
    leaves = [float(_leaf(a[i, j], b[i, j])) for a, b in quarters]
    values = np.empty(gradient.shape)
    values[: i + 1, : j + 1], values[: i + 1, j + 1 :], values[i + 1 :, : j + 1], values[i + 1 :, j + 1 :] = leaves
    return float(gains[i, j]), values


def fit(values: np.ndarray, labels: np.ndarray) -> Model:
    """Fit the model; without rows every score is one half, with a single label it leans to that label."""
    count = values.shape[1]
    cuts = [_quantiles(values[:, f], BINS) for f in range(count)]
    pair_cuts = [_quantiles(values[:, f], PAIR_BINS) for f in range(count)]
    ones = float(labels.sum())
    base = float(np.log((ones + 0.5) / (len(labels) - ones + 0.5)))
    bins = [np.searchsorted(c, values[:, f], side="right") for f, c in enumerate(cuts)]
    coarse = [np.searchsorted(c, values[:, f], side="right") for f, c in enumerate(pair_cuts)]
    tables, score = np.zeros((count, BINS)), np.full(len(labels), base)

    def residuals():
        p = 1.0 / (1.0 + np.exp(-score))
        return labels - p, p * (1.0 - p)

    for _ in range(ROUNDS):
        for f in range(count):
            gradient, hessian = residuals()
            g, h = (np.bincount(bins[f], x, BINS) for x in (gradient, hessian))
            step = RATE * _tree(g, h)
            tables[f] += step
            score += step[bins[f]]

    def pair_histogram(f, g, weights):
        flat = np.bincount(coarse[f] * PAIR_BINS + coarse[g], weights, PAIR_BINS * PAIR_BINS)
        return flat.reshape(PAIR_BINS, PAIR_BINS)

    gradient, hessian = residuals()
    every = [(f, g) for f in range(count) for g in range(f)]
    gains = [_pair_tree(pair_histogram(*p, gradient), pair_histogram(*p, hessian))[0] for p in every]
    pairs = [every[i] for i in np.argsort(-np.array(gains), kind="stable")[:PAIRS]]
    pair_tables = np.zeros((len(pairs), PAIR_BINS, PAIR_BINS))
    for _ in range(PAIR_ROUNDS):
        for i, (f, g) in enumerate(pairs):
            gradient, hessian = residuals()
            step = RATE * _pair_tree(pair_histogram(f, g, gradient), pair_histogram(f, g, hessian))[1]
            pair_tables[i] += step
            score += step[coarse[f], coarse[g]]
    return Model(base, cuts, tables, pair_cuts, pairs, pair_tables)


def is_held_out(id_col: str | Column) -> Column:
    """Rows whose labels are never learned from: crc32 of the id as text is divisible by five. A null id is one."""
    col = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % 5 == 0


@lean
def _sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = pa.array(list(_feature_rows(batch.column(3))), pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], rows], names=["id", "label", "hash", "values"])


def train(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Model:
    """Fit on the rows of `labels` (same id column; quality 0 or 1) that are not held out.

    Labels that are null, or that contradict each other for one id, are left out. Of several rows with one id, that of
    the smallest text hash is learned from, so that no id outweighs the others and `sample` bounds what reaches the driver.
    """
    known = (
        labels.where(F.col(id_col).isNotNull() & F.col("quality").isin(0, 1) & ~is_held_out(id_col))
        .groupBy(F.col(id_col).cast("long").alias("id"))
        .agg(F.min("quality").alias("label"), F.max("quality").alias("most"))
        .where("label = most")
    )
    chosen = known.orderBy(F.xxhash64("id"), "id").limit(sample).select("id", F.col("label").cast("long").alias("label"))
    texts = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    # The sample is bounded by its parameter: at most 20,000 pairs of numbers are broadcast.
    learned = texts.join(F.broadcast(chosen), "id").select("id", "label", F.xxhash64("text").alias("hash"), "text")
    measured = learned.mapInArrow(_sample_features, "id long, label long, hash long, values array<double>")
    first = F.min(F.struct("hash", "values", "label")).alias("first")
    rows = measured.groupBy("id").agg(first).select("first.label", "first.values").toPandas()
    values = np.array(rows["values"].tolist(), dtype=np.float64).reshape(len(rows), len(FEATURES))
    order = np.lexsort(values.T)  # the model must not hang on the order of arrival
    return fit(values[order], rows["label"].to_numpy(dtype=np.float64)[order])


@lean
def _score(model: Model, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        scores = model.score(_feature_rows(batch.column(1)))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], names=["doc_id", "score"])


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row; a null text is scored as an empty one.

    Repeated rows each give a row; other columns are not read; an empty table gives no rows.
    """
    narrow = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    scored = narrow.mapInArrow(partial(_score, model), "doc_id long, score double")
    return scored.select("doc_id", is_held_out("doc_id").alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


@lean
def _keep(model: Model, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        good = model.score(_feature_rows(batch.column(0))) >= THRESHOLD
        yield pa.RecordBatch.from_struct_array(batch.filter(pa.array(good)).column(1))


def keep_good(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of `df` that the model predicts to be good, with all their columns; cases as in `score`."""
    rows = df.select(F.col(text_col).alias("_text"), F.struct("*").alias("_doc"))
    return rows.mapInArrow(partial(_keep, model), df.schema)

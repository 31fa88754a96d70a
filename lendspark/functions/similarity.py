"""Jaro-Winkler similarity of names, and blocking keys that lose no pair above a floor.

The similarity is the published one: Jaro's mean of two match ratios and the share of matches in
order, raised by a tenth of the remaining distance for each of up to four equal leading characters
when Jaro itself exceeds 0.7.

Blocking. Write m for the matched characters of two names of lengths a and b that share p leading
characters. A score of at least `floor` needs Jaro >= (floor - p/10) / (1 - p/10), hence
m/a + m/b >= t with t = 3 * Jaro - 1, hence at most (2 - t) * max(a, b) characters stay unmatched on
both sides together; for given a and b the bound is a + b - 2 * t * a * b / (a + b). So if the
alphabet is dealt into one more class than that, at least one class holds the same characters in both
names. A key is the shared prefix, the length of the indexed name, the bound and the characters of one
class, for each length of the prefix up to four; every pair at or above the floor shares a key, while unlike
names seldom do, whatever their first letters.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

_PREFIX_WEIGHT = 0.1
_PREFIX_MAX = 4
_BOOST_ABOVE = 0.7
_SLACK = 1e-9
# Letters by rough frequency in names, so that dealing them out by rank gives classes of like weight.
_LETTER_RANKS = "a imhnerlsudoktyzbfqwjgcpxv"


def _code_points(names: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """Names as a zero-padded matrix of code points, and their lengths."""
    lengths = names.str.len().to_numpy(dtype=np.int64)
    width = max(int(lengths.max(initial=0)), 1)
    packed = np.array(names.to_list(), dtype=f"<U{width}")
    return packed.view(np.uint32).reshape(len(names), width), lengths


def jaro_winkler(left: pd.Series, right: pd.Series) -> pd.Series:
    """Similarity of each pair of non-null names, a whole Arrow batch at a time."""
    if len(left) == 0:
        return pd.Series([], dtype="float64")
    a, la = _code_points(left)
    b, lb = _code_points(right)
    rows = np.arange(len(left))
    reach = np.maximum(np.maximum(la, lb) // 2 - 1, 0)
    b_at = np.arange(b.shape[1])
    b_inside = b_at < lb[:, None]
    a_hit = np.zeros(a.shape, dtype=bool)
    b_hit = np.zeros(b.shape, dtype=bool)
    for i in range(a.shape[1]):
        near = np.abs(b_at - i) <= reach[:, None]
        free = near & b_inside & ~b_hit & (b == a[:, i, None]) & (i < la)[:, None]
        first = free.argmax(axis=1)
        hit = free[rows, first]
        a_hit[:, i] = hit
        b_hit[rows[hit], first[hit]] = True
    matches = a_hit.sum(axis=1)
    # matched characters of each name moved to the left, in their order
    a_seq = np.take_along_axis(np.where(a_hit, a, 0), np.argsort(~a_hit, axis=1, kind="stable"), axis=1)
    b_seq = np.take_along_axis(np.where(b_hit, b, 0), np.argsort(~b_hit, axis=1, kind="stable"), axis=1)
    shared = min(a_seq.shape[1], b_seq.shape[1])
    swaps = (a_seq[:, :shared] != b_seq[:, :shared]).sum(axis=1) // 2
    with np.errstate(divide="ignore", invalid="ignore"):
        jaro = (matches / la + matches / lb + (matches - swaps) / matches) / 3.0
    jaro = np.where(matches == 0, 0.0, jaro)
    jaro = np.where((la == 0) & (lb == 0), 1.0, jaro)
    head = min(_PREFIX_MAX, a.shape[1], b.shape[1])
    same = (a[:, :head] == b[:, :head]) & (b_at[:head] < np.minimum(la, lb)[:, None])
    prefix = np.cumprod(same, axis=1).sum(axis=1)
    boosted = jaro + _PREFIX_WEIGHT * prefix * (1.0 - jaro)
    return pd.Series(np.where(jaro > _BOOST_ABOVE, boosted, jaro))


@F.pandas_udf(DoubleType())
def _jaro_winkler_udf(left: pd.Series, right: pd.Series) -> pd.Series:
    return jaro_winkler(left, right)


# `jaro_winkler` as a column function over two non-null text columns. It is marked so that a filter on
# the score is not pushed below the projection, where each pair would be scored a second time.
jaro_winkler_column = _jaro_winkler_udf.asNondeterministic()


def _needed_ratio(floor: float, prefix: int) -> float:
    """t in the module text: the least m/a + m/b for a pair with `prefix` equal leading characters."""
    boost = _PREFIX_WEIGHT * prefix
    return 3.0 * (floor - boost) / (1.0 - boost) - 1.0


def _partners(length: Column, ratio: float) -> Column:
    """Lengths a name of this length can be matched with: m is at most the shorter length."""
    shortest = F.greatest(F.ceil(length * (ratio - 1.0) - _SLACK), F.lit(1).cast("bigint"))
    return F.sequence(shortest, F.floor(length / (ratio - 1.0) + _SLACK))


def _unmatched(a: Column, b: Column, ratio: float) -> Column:
    """Most characters two names of these lengths may leave unmatched; it has the parity of a + b."""
    total = a + b
    bound = F.floor(total - 2.0 * ratio * a * b / total + _SLACK)
    return bound - F.pmod(total - bound, F.lit(2))


def _class_keys(block: str, name: str, prefix: int, length: Column, unmatched: Column) -> Column:
    """One key per class when the alphabet is dealt into `unmatched` + 1 classes."""
    zero = F.lit(0).cast("bigint")
    classes = F.when(unmatched >= 0, F.sequence(zero, F.greatest(unmatched, zero))).otherwise(
        F.array().cast("array<bigint>")
    )
    shared = [F.col(block), F.lit(prefix), F.substring(name, 1, prefix), length, unmatched]
    return F.transform(
        classes,
        lambda k: F.xxhash64(*shared, k, F.filter("_letters", lambda x: x % (unmatched + 1) == k)),
    )


def _letter_ranks(name: str) -> Column:
    """Sorted letter ranks of a name; unlisted characters rank by code point."""

    def rank(x: Column) -> Column:
        listed = F.instr(F.lit(_LETTER_RANKS), x)
        return F.when(listed > 0, listed).otherwise(F.ascii(x))

    return F.array_sort(F.transform(F.split(name, ""), rank))


def _index_keys(block: str, name: str, prefix: int, ratio: float) -> Column:
    length = F.length(name).cast("bigint")
    bounds = F.transform(_partners(length, ratio), lambda a: _unmatched(a, length, ratio))
    return F.flatten(
        F.transform(F.array_distinct(bounds), lambda d: _class_keys(block, name, prefix, length, d))
    )


def _probe_keys(block: str, name: str, prefix: int, ratio: float) -> Column:
    length = F.length(name).cast("bigint")
    # Pairs first, so that the bound is computed once per length and not once per letter.
    partners = F.transform(
        _partners(length, ratio),
        lambda b: F.struct(b.alias("length"), _unmatched(length, b, ratio).alias("bound")),
    )
    return F.flatten(
        F.transform(partners, lambda p: _class_keys(block, name, prefix, p["length"], p["bound"]))
    )


def _with_keys(df: DataFrame, block: str, name: str, floor: float, keys) -> DataFrame:
    if floor <= _BOOST_ABOVE or _needed_ratio(floor, _PREFIX_MAX) <= 1.0:
        raise ValueError("blocking needs a floor high enough to bound the unmatched characters")
    by_class = [
        F.struct(F.lit(p).alias("prefix"), keys(block, name, p, _needed_ratio(floor, p)).alias("keys")) for p in range(_PREFIX_MAX + 1)
    ]
    ranked = df.where(F.length(name) > 0).withColumn("_letters", _letter_ranks(name))
    listed = ranked.select(*df.columns, F.inline(F.array(*by_class)))
    return listed.select(*df.columns, "prefix", F.explode("keys").alias("key"))


def with_index_keys(df: DataFrame, block: str, name: str, floor: float) -> DataFrame:
    """One row per prefix length and hashed key under which a name of a block can be found."""
    return _with_keys(df, block, name, floor, _index_keys)


def with_probe_keys(df: DataFrame, block: str, name: str, floor: float) -> DataFrame:
    """One row per prefix length and hashed key to look a name up with: any indexed name of the same block
    scoring at least `floor` has one of them, under the length of the prefix they share (`meets`). Unequal
    names or blocks may share a hash: verify the matches."""
    return _with_keys(df, block, name, floor, _probe_keys)


def meets(left: str, right: str, prefix: str) -> Column:
    """Whether two names that share a key of this prefix length begin to differ there; beyond the longest
    prefix it does not matter. A pair thus meets under one prefix length only."""
    length = F.col(prefix) + 1
    return (F.col(prefix) == _PREFIX_MAX) | (F.substring(left, F.lit(1), length) != F.substring(right, F.lit(1), length))


def letter_bits(name: str) -> Column:
    """struct(bits, rest, inverse) of a name: two bits per listed letter, set if it occurs at least once and at least
    twice, the number of letters that these bits leave out, and one over the length. Plain text functions, so that a
    name costs a few microseconds."""
    length = F.length(name)
    total = F.lit(0).cast("bigint")
    for rank, letter in enumerate(_LETTER_RANKS):
        without = F.length(F.replace(F.col(name), F.lit(letter), F.lit("")))
        once, twice = (F.lit(bits << (2 * rank)).cast("bigint") for bits in (1, 3))
        total = total.bitwiseOR(F.when(without == length, F.lit(0).cast("bigint")).when(without == length - 1, once).otherwise(twice))
    return F.struct(
        total.alias("bits"), (length - F.bit_count(total)).alias("rest"), F.when(length > 0, 1.0 / length).otherwise(0.0).alias("inverse")
    )


def with_letter_bits(df: DataFrame, name: str, out: str) -> DataFrame:
    """Adds the letter bits of a name, for `may_reach`."""
    return df.withColumn(out, letter_bits(name))


def may_reach(left: str, right: str, left_bits: str, right_bits: str, floor: float) -> Column:
    """False only where the letters two names have in common rule out a score of `floor`.

    Common letters are bounded from above by the common bits and the smaller rest. This takes a few
    machine operations per pair, so that only likely pairs go on to be scored; prefixes are compared only
    for pairs that would do with the longest.
    """
    common = F.bit_count(F.col(left_bits)["bits"].bitwiseAND(F.col(right_bits)["bits"])) + F.least(
        F.col(left_bits)["rest"], F.col(right_bits)["rest"]
    )
    share = common * (F.col(left_bits)["inverse"] + F.col(right_bits)["inverse"])
    least = F.lit(_needed_ratio(floor, _PREFIX_MAX))
    needed = least
    for prefix in reversed(range(_PREFIX_MAX)):
        differs = F.substring(left, 1, prefix + 1) != F.substring(right, 1, prefix + 1)
        needed = F.when(differs, F.lit(_needed_ratio(floor, prefix))).otherwise(needed)
    return (share >= least - _SLACK) & (share >= needed - _SLACK)

"""Fuzzy search for short licence notices.

A text is reduced to its words, lower-cased and joined by single spaces. A notice of n characters may differ
in n / 10 edits (insertions, deletions, substitutions). By the pigeonhole rule one of k + 1 pieces of a
notice stands unchanged in any place with at most k edits, so plain substring searches for the pieces find
every candidate; only the words around a hit are given to the regex library, whose bounded-error matching
decides and counts the edits. A place begins and ends with whole words.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendspark.llm.common import lean

# Phrases whose exact places are counted, and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Further notices, found with edits only by the method.
NOTICES = {
    "gnu lesser general public license": "lgpl",
    "licensed under the apache license version 2 0": "apache",
    "permission is hereby granted free of charge to any person": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "mozilla public license": "mpl",
    "creative commons attribution": "cc-by",
    "all rights reserved": "reserved",
}
CHARACTERS_PER_EDIT = 10

_KEPT = set(range(0x30, 0x3A)) | set(range(0x61, 0x7B)) | set(range(0x80, 0x100))
_TO_WORDS = bytes(b if b in _KEPT else 0x20 for b in bytes(range(256)).lower())

SPAN = "struct<label:string,notice:string,first_word:bigint,words:bigint,edits:int>"
SCHEMA = f"doc_id long, n_words long, base_starts array<bigint>, base_labels array<string>, spans array<{SPAN}>"


def edits_of(notice: str) -> int:
    return len(notice) // CHARACTERS_PER_EDIT


def pieces(notice: str) -> list[tuple[int, str]]:
    """(offset, piece): the notice in one piece more than it may have edits."""
    count = edits_of(notice) + 1
    bounds = [len(notice) * i // count for i in range(count + 1)]
    return [(a, notice[a:b]) for a, b in zip(bounds, bounds[1:])]


@lru_cache(maxsize=None)
def _matcher(notice: str):
    return regex.compile(rf"(?b)(?<![^ ])(?:{regex.escape(notice, literal_spaces=True)}){{e<={edits_of(notice)}}}(?![^ ])")


def _places(text: str, piece: str) -> Iterator[int]:
    at = text.find(piece)
    while at >= 0:
        yield at
        at = text.find(piece, at + 1)


class _Words:
    """Where the words of a text of words begin, found once and only if asked for."""

    def __init__(self, text: str):
        self.text = text

    @cached_property
    def starts(self) -> np.ndarray:
        letters = np.frombuffer(self.text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        return np.concatenate([[0], np.flatnonzero(letters == ord(" ")) + 1])

    def number(self, at: int) -> int:
        """The number of the word that holds the character `at`."""
        return int(np.searchsorted(self.starts, at, side="right")) - 1

    def near(self, places: np.ndarray, slack: int) -> np.ndarray:
        """Beginnings of words that are no further than `slack` characters from one of the places, which may lie outside."""
        low = np.searchsorted(self.starts, places - slack)
        counts = np.searchsorted(self.starts, places + slack, side="right") - low
        offsets = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        return np.unique(self.starts[np.repeat(low, counts) + offsets])


def _starts(words: _Words, notice: str) -> np.ndarray:
    """Beginnings of words at which the notice may stand: an unchanged piece is where it would put it, edits apart."""
    places = [at - offset for offset, piece in pieces(notice) for at in _places(words.text, piece)]
    return words.near(np.array(places, dtype=np.int64), edits_of(notice)) if places else np.empty(0, dtype=np.int64)


def words_of(text: bytes) -> str:
    return b" ".join(text.translate(_TO_WORDS).split()).decode("utf-8", "replace")


def base_places(text: str) -> list[tuple[int, str]]:
    """(first word, label) of every exact place of a base phrase in a text of words; places may overlap."""
    found, words = [], _Words(text)
    for phrase, label in BASE.items():
        _, seed = pieces(phrase)[0]
        for at in _places(text, seed):
            end = at + len(phrase)
            if text[at:end] == phrase and (at == 0 or text[at - 1] == " ") and (end == len(text) or text[end] == " "):
                found.append((words.number(at), label))
    return sorted(found)


def _best_places(words: _Words, notice: str) -> list[regex.Match]:
    """The best place from every word on; of places that overlap the one with the fewest edits, then the first."""
    matches, reach = [], len(notice) + edits_of(notice)
    for at in _starts(words, notice).tolist():
        end = words.text.find(" ", at + reach)  # a blank ends a place as the end of the text does
        match = _matcher(notice).match(words.text, at, len(words.text) if end < 0 else end)
        if match:
            matches.append(match)
    begins: list[int] = []  # of the chosen places, which are apart from each other
    chosen: dict[int, regex.Match] = {}
    for match in sorted(matches, key=lambda m: (sum(m.fuzzy_counts), m.start())):
        next_ = bisect_right(begins, match.start())
        if next_ and chosen[begins[next_ - 1]].end() > match.start():
            continue
        if next_ < len(begins) and begins[next_] < match.end():
            continue
        begins.insert(next_, match.start())
        chosen[match.start()] = match
    return list(chosen.values())


def spans_of(text: str) -> list[dict]:
    """The verified places of all notices in a text of words; those of one notice do not overlap."""
    found, words = [], _Words(text)
    for notice, label in (*BASE.items(), *NOTICES.items()):
        for match in _best_places(words, notice):
            size = match.group().strip().count(" ") + 1
            first = words.number(match.start())
            found.append({"label": label, "notice": notice, "first_word": first, "words": size, "edits": sum(match.fuzzy_counts)})
    return sorted(found, key=lambda s: (s["first_word"], s["notice"], s["words"]))


@lean
def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.list_(pa.struct([("label", pa.string()), ("notice", pa.string()), ("first_word", pa.int64()), ("words", pa.int64()), ("edits", pa.int32())]))
    for batch in batches:
        rows = []
        for text in pc.cast(batch.column(1), pa.binary()):
            words = words_of(text.as_py() or b"")
            base = base_places(words)
            count = words.count(" ") + 1 if words else 0
            rows.append((count, [p for p, _ in base], sorted({label for _, label in base}), spans_of(words)))
        types = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()), span)
        columns = [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(types)]
        yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "n_words", "base_starts", "base_labels", "spans"])


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, base_starts, base_labels, spans) for every row of `df`, without a shuffle.

    `base_starts` are the first words of the exact places of base phrases; `spans` the verified places of all
    notices with their edits. A null or empty text has no words and no places. Repeated rows and null ids
    each give a row; other columns are not read; an empty table gives no rows.
    """
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(_scan, SCHEMA)


def summary(found: DataFrame) -> DataFrame:
    """One row of figures per document of `scan`; score is 1 less the share of edits in the best place, or 0."""
    labels = F.array_union("base_labels", F.transform("spans", lambda s: s["label"]))
    closeness = F.transform("spans", lambda s: 1 - s["edits"] / F.length(s["notice"]))
    return found.select(
        "doc_id",
        "n_words",
        F.size("base_starts").cast("long").alias("n_base"),
        F.array_min("base_starts").alias("first_word"),
        F.array_max("base_starts").alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join(F.array_sort(labels), ",").alias("labels"),
        F.coalesce(F.array_max(closeness), F.lit(0.0)).alias("score"),
    )

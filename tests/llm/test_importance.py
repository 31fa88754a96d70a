"""Importance resampling against plain Python."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_tables import documents, no_documents, prose, rows
from pyspark.sql import functions as F

from lendspark.llm import importance

SMALL = str.maketrans({chr(c): chr(c + 32) for c in range(ord("A"), ord("Z") + 1)})
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_buckets(text):
    words = WORD.findall((text or "").translate(SMALL))
    return len(words), [zlib.crc32(" ".join(words[i : i + k]).encode()) % 10000 for k in (1, 2, 3) for i in range(len(words) - k + 1)]


def plain(table, target, percent=5):
    docs = [(doc_id, *plain_buckets(text)) for doc_id, text in table]
    s, t = Counter(b for d in docs for b in d[2]), Counter(b for text in target for b in plain_buckets(text)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1.0) * (s_all + 10000) / ((s[b] + 1.0) * (t_all + 10000)))) for b in range(10000)}
    scored = []
    for doc_id, n, found in docs:
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in found)
        scored.append([doc_id, n, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    fit = sorted((d for d in scored if d[1] >= 20), key=lambda d: (-d[4], d[0] is None, d[0] or 0))
    rank = {id(d): i + 1 for i, d in enumerate(fit[: percent * len(fit) // 100])}
    return Counter((d[0], d[2], d[3], d[4], rank.get(id(d))) for d in scored)


TARGET = [prose(500, 70), None, "", "Released under the GNU General Public License"]


@pytest.mark.parametrize("clashing, percent", [(False, 5), (True, 60), (False, 100)])
def test_resample(spark, clashing, percent):
    docs = documents(spark, clashing).withColumn("weight", F.lit("own")).withColumn("rank", F.lit("own"))
    target = spark.createDataFrame([(t, 1) for t in TARGET], "text string, key long")
    got = Counter(tuple(r) for r in importance.resample(docs, target, percent=percent).collect())
    assert got == plain([(r[0], r[1]) for r in rows()], TARGET, percent)


def test_many_repeats_of_one_row_are_ranked_one_after_the_other(spark):
    table = [(7, prose(3, 30))] * 300 + [(i, prose(i, 25)) for i in range(100)]
    df = spark.createDataFrame(table, "doc_id long, text string").repartition(7)
    target = spark.createDataFrame([(prose(3, 30),)], "text string")
    found = importance.resample(df, target, percent=90).collect()
    assert sorted(r["rank"] for r in found if r["rank"]) == list(range(1, 361))
    assert Counter(map(tuple, found)) == plain(table, [prose(3, 30)], 90)


def test_drawn_rows_keep_their_columns(spark, tmp_path):
    documents(spark, clashing=True).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    target = spark.createDataFrame([(t,) for t in TARGET], "text string")
    drawn = importance.drawn_rows(docs, target, percent=50)
    want = Counter()
    for (doc_id, *_, rank), count in plain([(r[0], r[1]) for r in rows()], TARGET, 50).items():
        want[doc_id] += count * (rank is not None)
    assert drawn.columns == docs.columns
    assert Counter(r["doc_id"] for r in drawn.collect()) == +want


def test_empty_tables(spark):
    nothing, target = no_documents(spark), spark.createDataFrame([(TARGET[0],)], "text string")
    assert importance.resample(nothing, target).count() == 0
    got = Counter(tuple(r) for r in importance.resample(documents(spark), target.limit(0), percent=30).collect())
    assert got == plain([(r[0], r[1]) for r in rows()], [], 30)


@pytest.mark.parametrize("texts", [[""], ["a"], ["a b", "", "a"], ["x" * 5000 + " y", "y " + "x" * 5000], ["éß a\x80b", "A-a A-a"], ["ab", "cd ef", " gh"]])
def test_features_of_a_batch(texts):
    bucket, text, words = importance.features(pa.array(["skipped", *texts]).slice(1))
    for i, t in enumerate(texts):
        n, want = plain_buckets(t)
        assert words[i] == n and sorted(bucket[text == i].tolist()) == sorted(want)


def test_crcs_of_slices_of_every_length(monkeypatch):
    monkeypatch.setattr(importance, "_CELLS_AT_ONCE", 64)
    data = np.random.default_rng(1).integers(0, 256, 3000, dtype=np.uint8)
    start, size = np.arange(600), np.arange(600) // 2
    want = [zlib.crc32(data[s : s + n].tobytes()) for s, n in zip(start.tolist(), size.tolist())]
    assert importance.crcs(data, start, size).tolist() == want

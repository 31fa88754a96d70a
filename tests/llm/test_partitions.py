"""Nearest neighbours over learned partitions against brute force."""

from __future__ import annotations

import math
from collections import defaultdict
from functools import reduce

import numpy as np
import pytest

from lendspark.llm import partitions

SCHEMA = "vec_id long, embedding array<float>, rank string, unit string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, "own", "own") for i, v in rows], SCHEMA).repartition(3)


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)


def product(v, w):
    """Added up in order; `sum` would carry more than a double."""
    return reduce(lambda total, pair: total + float(pair[0]) * float(pair[1]), zip(v, w), 0.0)


def plain(rows, k=20, every=20):
    distinct = {(i, tuple(np.float32(x) for x in v)) for i, v in rows if i is not None and usable(v)}
    found = []
    for i, v in distinct:
        if i % every == 0:
            others = [(product(v, w), -j) for j, w in distinct if (j, w) != (i, v) and len(w) == len(v)]
            found += [(i, r + 1, -j, s) for r, (s, j) in enumerate(sorted(others, reverse=True)[:k])]
    return sorted(found)


def got(df):
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in df.collect())


def random_rows(seed, count, dim, groups=(), spread=0.05):
    pick = np.random.default_rng(seed)
    parts = [pick.normal(size=dim) + spread * pick.normal(size=(size, dim)) for size in groups]
    return list(enumerate(np.concatenate([*parts, pick.normal(size=(count, dim))]).astype(np.float32).tolist()))


def test_awkward_rows(spark):
    rows = [
        (0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 2.0]), (20, [1.0, 0.0]), (20, [1.0, 0.0]), (20, [0.0, -3.0]), (40, None), (60, []), (80, [0.0, 0.0]),
        (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (100, [1.0, None]), (None, [5.0, 5.0]), (5, [1.0, 2.0, 3.0]), (120, [3.0, 2.0, 1.0]),
        (6, [1.0, 0.0]), (-20, [-1.0, 1.0]), (7, [-0.0, 2.0]), (140, [1.0]),
    ]
    found = partitions.nearest(table(spark, rows))
    assert got(found) == plain(rows)
    assert found.columns == ["query_id", "rank", "vec_id", "score", "recall"]
    assert partitions.nearest(table(spark, rows).limit(0)).count() == 0
    assert partitions.nearest(table(spark, rows[6:9])).count() == 0


def recall(rows, found, k=20):
    want, have = defaultdict(set), defaultdict(set)
    for query, _, other, _ in plain(rows, k):
        want[query].add(other)
    for query, _, other, _ in found:
        have[query].add(other)
    return float(np.mean([len(want[q] & have[q]) / len(want[q]) for q in want]))


def test_one_vector_held_by_a_third_of_all_rows(spark, monkeypatch):
    monkeypatch.setattr(partitions, "LEAF", 40)
    rows = random_rows(5, 200, 8)
    rows += [(1000 + i, rows[0][1]) for i in range(100)]
    found = got(partitions.nearest(table(spark, rows)))
    assert recall(rows, found) >= 0.9
    copies = [r for r in found if rows[0][1] == dict(rows)[r[0]]]
    assert copies == [r for r in plain(rows) if rows[0][1] == dict(rows)[r[0]]]  # all of them are in the leaf of their vector


@pytest.mark.parametrize("groups, chunk, fanout", [((150, 60, 30, 30, 30), 4096, 128), ((150, 60, 30, 30, 30), 50, 3), ((600,), 100, 4)])
def test_recall_on_leaves_that_do_not_hold_everything(spark, monkeypatch, groups, chunk, fanout):
    for name, value in {"LEAF": 40, "CHUNK": chunk, "FANOUT": fanout, "FIRST_WIDTH": 4}.items():
        monkeypatch.setattr(partitions, name, value)
    rows = random_rows(7, 400, 16, groups)
    df = partitions.nearest(table(spark, rows)).cache()
    found = got(df)
    assert df.select("recall").distinct().count() == 1 and df.first()["recall"] >= 0.95
    assert recall(rows, found) >= 0.9
    score = {(i, j): s for i, _, j, s in plain(rows, k=len(rows))}
    assert all(score[i, j] == s for i, _, j, s in found)
    ranks = defaultdict(list)
    for query, rank, _, _ in found:
        ranks[query].append(rank)
    assert all(r == list(range(1, 21)) for r in ranks.values()) and len(ranks) == len([i for i, _ in rows if i % 20 == 0])


def test_clusters_need_few_leaves(spark, monkeypatch):
    monkeypatch.setattr(partitions, "LEAF", 40)
    rows = random_rows(3, 0, 16, [40] * 20, spread=0.2)
    units = partitions.cut(partitions._units(table(spark, rows).selectExpr("vec_id AS id", "embedding AS vec"), 21))
    members, models = partitions.build(units)
    assert len(models) >= 1 and members.count() == len(rows) and members.select("unit").distinct().count() == len(rows)
    asking = units.select("unit", "root", "vec")
    leaves, share = partitions._leaves_needed(asking, members, models, 20)
    assert leaves <= 5 and share >= 0.95 and members.select("node").distinct().count() >= 10


def test_parts_are_balanced_and_follow_the_graph():
    pick = np.random.default_rng(2)
    rows = (np.repeat(pick.normal(size=(8, 12)), 50, axis=0) + 0.1 * pick.normal(size=(400, 12)))[pick.permutation(400)]
    near = partitions.neighbour_graph(rows)
    label = partitions.balanced_parts(rows, near, 8)
    assert np.bincount(label, minlength=8).max() <= 53 and np.bincount(label, minlength=8).min() >= 20
    assert (label[near] == label[:, None]).mean() > 0.85


def test_equal_directions_cannot_be_told_apart_and_end_in_one_leaf(spark, monkeypatch):
    monkeypatch.setattr(partitions, "LEAF", 10)
    monkeypatch.setattr(partitions, "CHUNK", 16)
    rows = [(i, [1.0 + i, 2.0 + 2 * i]) for i in range(60)]
    assert got(partitions.nearest(table(spark, rows))) == plain(rows)

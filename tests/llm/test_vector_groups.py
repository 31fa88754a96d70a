"""Large groups of near copies among the vectors of one part."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from lendspark.llm import embeddings


def grouped(sizes, loose=0, spread=0.01, dim=64):
    pick = np.random.default_rng(11)
    parts = [pick.normal(size=dim) + spread * pick.normal(size=(size, dim)) for size in sizes]
    return np.concatenate([*parts, pick.normal(size=(loose, dim))])


def true_links(rows):
    unit = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    return (unit @ unit.T >= embeddings.THRESHOLD).sum(axis=1) - 1


@pytest.mark.parametrize("sizes, loose", [((600, 300, 100), 0), ((100, 100, 100, 100), 0), ((600, 300, 100), 100)])
def test_every_large_group_of_a_part_is_found(sizes, loose):
    rows = grouped(sizes, loose)
    group = pd.DataFrame({"node": np.arange(len(rows)), "vec": list(rows), "n": 1})
    stock = group.merge(embeddings._build(group), on="node").assign(role=0)
    found = embeddings._search(embeddings.THRESHOLD, embeddings.BEAM, pd.concat([stock, group.assign(role=1, near=None)]))
    assert found.groupby("node")["links"].sum().sort_index().tolist() == true_links(rows).tolist()
    linked = found[found["node"] != found["root"]]
    assert len(set(linked["root"])) == len(sizes)
    assert len(linked) == sum(sizes) - len(sizes)


def test_lost_small_groups_are_noticed_and_found(spark, monkeypatch):
    sizes = (120, 12, 12, 2, 2)
    rows = grouped(sizes, loose=20)
    ids = list(range(len(rows)))
    search = embeddings._links

    def only_the_first_group(vectors, *args):
        found = search(vectors, *args).join(vectors.select("node", "low"), "node")
        return found.where(found.low < sizes[0]).select("node", "links", "root")

    monkeypatch.setattr(embeddings, "_links", only_the_first_group)
    monkeypatch.setattr(embeddings, "PART", 50)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, rows)], "vec_id long, embedding array<double>")
    got = sorted(map(tuple, embeddings.near_duplicates(df).collect()))
    first = np.concatenate([np.repeat(np.cumsum((0, *sizes[:-1])), sizes), np.arange(sum(sizes), len(rows))])
    assert [r[:3] for r in got] == list(zip(ids, true_links(rows).tolist(), first.tolist()))


def test_loose_vectors_are_no_entries():
    rows = grouped((5, 2), loose=600)
    vectors = embeddings._unit(rows)
    lists = embeddings.robust_prune(vectors @ vectors.T)
    size = np.array([len(x) for x in lists])
    doors = embeddings._entries(vectors, (np.cumsum(size) - size, size, np.concatenate(lists)), embeddings.THRESHOLD - 0.05)
    assert 3 <= len(doors) < 0.05 * len(rows)
    assert {0, 5} <= set(doors.tolist())


def test_an_audit_that_saw_no_link_claims_nothing(spark):
    rows = grouped((), loose=300)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], "vec_id long, embedding array<double>")
    found = embeddings.near_duplicates(df)
    assert {r["recall"] for r in found.collect()} == {None} and found.where("n_links > 0").count() == 0


def test_a_vector_is_in_a_bounded_number_of_shards():
    rows = grouped((), loose=200)
    centroids = embeddings._unit(grouped((), loose=64))
    batch = pa.RecordBatch.from_pydict({"node": list(range(200)), "vec": rows.tolist(), "n": [1] * 200})
    shared = type("Shared", (), {"value": centroids})
    members = pa.Table.from_batches(embeddings._assign(shared, 10.0, 4, iter([batch])))
    assert members.num_rows == 800 and sum(members.column("home").to_pylist()) == 200

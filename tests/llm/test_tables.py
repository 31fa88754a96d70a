"""URL verdicts, mixing, repeated passages, vectors and the pipeline against plain Python."""

from __future__ import annotations

import math
import os
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_tables import documents, no_documents, prose, rows

import corpus_pipeline
from lendspark.llm import embeddings, mixing, suffixes, urls
from lendspark.session import cut

URLS = [
    (1, "http://a.example.net/en/1"), (2, "http://a.example.net/fr/1?utm_source=x"), (3, "https://WWW.Example.COM/de/x#top"),
    (4, "https://example.com/de"), (5, "https://m.other.org/fr/1/"), (6, "https://m.other.org/FR/1"), (7, "ftp://notnet/"),
    (8, None), (9, ""), (10, "no scheme"), (11, "http://net"), (12, "http://net/"), (13, "x://y://net/z"),
    (14, "https://site.io/a/?b=1&utm_x=2"), (15, "http://www.site.io/a?b=1"), (16, "https://site.io/a?b=2"), (None, "https://site.io/a?b=1#f"),
    (17, "http:///only/path"), (1, "http://a.example.net/en/1"),
]


def plain_url(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host, path, query = re.match(r"([^/?#]*)([^?#]*)(?:\?([^#]*))?", rest).groups()
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    kept = "&".join(p for p in (query or "").split("&") if not p.startswith("utm_")) if query else ""
    bare = host.removeprefix("www.")
    return host, path, bare + path.rstrip("/") + ("?" + kept if kept else "") if bare else None


@pytest.mark.parametrize("limit", [0, 1 << 24])
def test_url_verdicts(spark, monkeypatch, limit):
    monkeypatch.setattr(urls, "FILTER_BYTES", limit)
    pages = spark.createDataFrame(URLS, "page_id long, url string").selectExpr("*", "'x' AS key", "'y' AS block", "'z' AS host")
    listed = spark.createDataFrame([("https://site.io/a?b=1",), (None,), ("http://x.net/y",)], "url string")
    want = Counter()
    for page_id, url in URLS:
        host, path, key = plain_url(url)
        fits = [
            (len(rule), rule, verdict)
            for verdict, rule in urls.RULES
            if ("." + host).endswith("." + rule.partition("/")[0]) and path.startswith("/" + rule.partition("/")[2])
        ]
        _, rule, verdict = max(fits, default=(0, None, None))
        hit = key == "site.io/a?b=1"
        want[(page_id, host, path, rule, verdict or ("block" if hit else "allow"), hit)] += 1
    assert Counter(map(tuple, urls.judge(pages, listed).collect())) == want
    assert urls.judge(pages.limit(0), listed).count() == 0
    assert urls.judge(pages, listed.limit(0)).where("listed").count() == 0


def test_the_filter_lets_every_listed_url_pass(spark):
    listed = spark.range(5000).selectExpr("concat('http://h', id % 7, '.io/', id) AS url")
    pages = spark.range(10000).selectExpr("id AS page_id", "concat('https://h', id % 7, '.io/', id) AS url")
    assert [r["page_id"] for r in urls.judge(pages, listed).where("listed").orderBy("page_id").collect()] == list(range(5000))


def plain_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    full = set()
    while True:
        room = sum(sizes.values()) - sum(3 * sizes[s] for s in full)
        shares = sum(weight[s] for s in order if s not in full) or 1
        goal = {s: 3.0 * sizes[s] if s in full else room * weight[s] / shares for s in order}
        above = {s for s in order if s not in full and goal[s] > 3 * sizes[s]}
        if not above:
            return goal
        full |= above


def test_mix(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 50)
    docs = documents(spark, clashing=True)
    got = mixing.mix(docs).collect()
    assert len(got) == docs.count()
    sizes = defaultdict(int)
    for _, text, _, source, _ in rows():
        sizes[source] += len((text or "").split())
    goal = plain_targets(sizes)
    taken = defaultdict(int)
    by_size = {(s, round(goal[s], 6)): s for s in sizes}
    assert len(by_size) == len(sizes)
    by_target = {round(goal[s], 6): s for s in sizes}
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"]
        assert r["source_size"] == sizes[by_target[round(r["target"], 6)]]
        taken[by_target[round(r["target"], 6)]] += r["taken"]
    assert all(taken[s] == round(goal[s]) for s in sizes)
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((i, len((t or "").split())) for i, t, *_ in rows())
    again = mixing.mix(docs.repartition(5)).collect()
    assert Counter((r["doc_id"], r["taken"]) for r in got) == Counter((r["doc_id"], r["taken"]) for r in again)
    assert mixing.mix(no_documents(spark)).count() == 0


def test_the_tree_splits_every_node_evenly_and_keeps_all_blocks(spark):
    draws = spark.range(1000).selectExpr("CAST(id AS STRING) AS draw", "id % 3 AS source")
    shards = [r["shard"] for r in mixing.split_tree(draws).collect()]
    sizes = Counter(shards)
    assert len(shards) == 1000 and set(sizes) == set(range(mixing.SHARDS))
    assert max(sizes.values()) - min(sizes.values()) <= 2


def test_mixed_rows_repeat_whole_rows(spark):
    docs = documents(spark, clashing=True)
    out = mixing.mixed_rows(docs)
    assert out.columns == docs.columns
    known = {(r["doc_id"], r["text"]) for r in docs.collect()}
    times = Counter((r["doc_id"], r["text"]) for r in out.collect())
    assert set(times) <= known and max(times.values()) <= 6  # a row that is there twice may come thrice each
    assert mixing.mixed_rows(no_documents(spark)).count() == 0


def test_copies_lie_in_the_order_of_shard_and_position(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 40)
    table = [(i, prose(i, 20), "b" if i % 10 else "a") for i in range(200)]
    docs = spark.createDataFrame(table, "doc_id long, text string, source string")
    drawn = {r["doc_id"]: r for r in mixing.mix(docs).collect()}
    out = [r["doc_id"] for r in mixing.mixed_rows(docs).collect()]
    want = [(d["shard"], d["position"], i) for i, r in drawn.items() for d in r["draws"][: round(r["taken"] / r["size"])]]
    assert out == [i for _, _, i in sorted(want)]
    assert max(Counter(out).values()) == 3 and sum(a == b for a, b in zip(out, out[1:])) < len(out) / 10


def test_order_over_partitions(spark):
    df = spark.range(500).selectExpr("(id * 7919) % 1000 AS v")
    got = mixing.in_order(df.repartition(6), ["v"], "rank").collect()
    assert [r["v"] for r in sorted(got, key=lambda r: r["rank"])] == sorted(r["v"] for r in got)
    assert sorted(r["rank"] for r in got) == list(range(500))


def covered(texts):
    where = defaultdict(set)
    words = {key: (text or "").split() for key, text in texts.items()}
    size = suffixes.PASSAGE
    for key, w in words.items():
        for i in range(len(w) - size + 1):
            where[tuple(w[i : i + size])].add(key)
    out = {}
    for key, w in words.items():
        flags = np.zeros(len(w), dtype=bool)
        for i in range(len(w) - size + 1):
            if len(where[tuple(w[i : i + size])]) > 1:
                flags[i : i + size] = True
        out[key] = flags
    return out


@pytest.mark.parametrize("at_once", [5, 1 << 16])
def test_repeated_passages(spark, monkeypatch, at_once):
    monkeypatch.setattr(suffixes, "_ROWS_AT_ONCE", at_once)
    pick = random.Random(9)
    passages = [prose(900 + i, 60 + 25 * i) for i in range(4)]
    texts = {i: text for i, text, *_ in rows() if i is not None}
    for i in range(30):
        parts = [prose(2000 + i, 20), *pick.sample(passages, pick.randint(0, 2)), prose(3000 + i, 30)]
        texts[300 + i] = " ".join(parts)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").withColumnRenamed("text", "text")
    got = suffixes.repeated_passages(df.selectExpr("*", "1 AS gram", "2 AS key").repartition(5)).collect()
    found = {i: np.zeros(len((t or "").split()), dtype=bool) for i, t in texts.items()}
    for r in got:
        assert r["end"] - r["begin"] >= suffixes.PASSAGE and r["other_id"] != r["doc_id"]
        found[r["doc_id"]][r["begin"] : r["end"]] = True
    want = covered(texts)
    assert all((found[i] == want[i]).all() for i in texts)


def test_a_document_does_not_repeat_itself(spark):
    rows_ = [(1, "la la la " * 60), (1, "la la la " * 60), (None, prose(77, 80)), (2, None), (3, "")]
    df = spark.createDataFrame(rows_, "doc_id long, text string")
    assert suffixes.repeated_passages(df).count() == 0
    assert suffixes.repeated_passages(df.limit(0)).count() == 0


def vectors():
    pick = np.random.default_rng(11)
    found = []
    for i in range(60):
        centre = pick.normal(size=12)
        found += [(i * 20 + j, (centre + pick.normal(scale=0.05 * (j % 4), size=12)).tolist()) for j in range(8)]
    found += [(5000 + i, found[0][1]) for i in range(30)] + [(6000, (np.array(found[1][1]) * 1e-30).tolist())]
    found += [(7000, None), (7001, []), (7002, [0.0] * 12), (7003, [float("nan")] + [1.0] * 11), (7004, [float("inf")] * 12)]
    found += [(7005, [None] + [1.0] * 11), (7006, [1.0, 2.0]), (7007, [2.0, 4.0]), (None, found[0][1]), (0, found[0][1])]
    return found


def test_vectors(spark):
    data = vectors()
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>").selectExpr("*", "1 AS node", "2 AS vec").repartition(4)
    got = embeddings.near_duplicates(df).collect()
    good = [(i, np.array(v, dtype=float)) for i, v in data if v and None not in v and np.isfinite(np.array(v, dtype=float)).all() and any(v)]

    def cosine(a, b):
        return len(a) == len(b) and a @ b / math.sqrt(a @ a) / math.sqrt(b @ b) >= 0.95

    links = [[j for j in range(len(good)) if j != i and cosine(good[i][1], good[j][1])] for i in range(len(good))]
    root = list(range(len(good)))
    for i in range(len(good)):  # label by search
        if root[i] == i:
            stack = [i]
            while stack:
                for j in links[stack.pop()]:
                    if root[j] != i and j > i:
                        root[j] = i
                        stack.append(j)
    lowest = defaultdict(list)
    for i, (vec_id, _) in enumerate(good):
        lowest[root[i]] += [vec_id] if vec_id is not None else []
    want = Counter((vec_id, len(links[i]), min(lowest[root[i]]), vec_id == min(lowest[root[i]])) for i, (vec_id, _) in enumerate(good))
    want.update((i, 0, i, True) for i in range(7000, 7006))
    recall = {r["recall"] for r in got} - {None}
    assert min(recall) >= 0.9
    assert Counter(tuple(r)[:4] for r in got) == want
    assert embeddings.near_duplicates(df.limit(0)).count() == 0


def test_parts_of_a_large_shard_meet_all_queries(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "PART", 16)
    df = spark.createDataFrame([(i, v) for i, v in vectors()[:200]], "vec_id long, embedding array<double>")
    counts = embeddings.near_duplicates(df).collect()
    rows_ = np.array([v for _, v in vectors()[:200]])
    unit = rows_ / np.linalg.norm(rows_, axis=1, keepdims=True)
    want = dict(zip([i for i, _ in vectors()[:200]], ((unit @ unit.T >= 0.95).sum(axis=1) - 1).tolist()))
    assert {r["vec_id"]: r["n_links"] for r in counts} == want


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="given tables not present")
def test_pipeline(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, kept = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = cut(stage(spark, kept, sf_dir))
        assert kept.columns == columns, name
    last = corpus_pipeline.STAGES[-1][1](spark, kept, sf_dir)
    assert Counter(r["doc_id"] for r in last.collect()) == Counter(r["doc_id"] for r in kept.collect())
    assert Counter(map(tuple, corpus_pipeline.run(spark, sf_dir).collect())) == Counter(map(tuple, last.collect()))


def test_pipeline_of_awkward_and_empty_tables(spark, tmp_path):
    spark.createDataFrame([(13, 0, 0), (1, 1, 0), (9, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for docs in (documents(spark, clashing=True), no_documents(spark)):
        for _, stage in corpus_pipeline.STAGES:
            docs = cut(stage(spark, docs, str(tmp_path)))
        assert docs.count() >= 0

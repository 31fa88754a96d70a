"""Exact and near duplicates against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from llm_tables import documents, no_documents, rows, stored

from lendspark.llm import exact_dedup, simhash
from lendspark.llm.bktree import Forest
from lendspark.llm.components import components

BLANK = re.compile(r"[\x20\x09-\x0D]+")


def groups(label):
    """Smallest node of each node's component, from pairs."""
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in label:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(parent)}


def expected_exact():
    by_text = defaultdict(list)
    for number, (doc_id, text, *_) in enumerate(rows()):
        by_text[BLANK.sub("", text or "")].append((-len(text or ""), doc_id is None, doc_id or 0, doc_id))
    out = Counter()
    for text, members in by_text.items():
        best = min(members)
        digest = hashlib.sha256(text.encode()).hexdigest()
        for number, member in enumerate(sorted(members)):
            out[(member[3], best[3], len(members), number == 0, digest)] += 1
    return out


@pytest.mark.parametrize("clashing", [False, True])
def test_exact_duplicates(spark, clashing):
    got = exact_dedup.exact_duplicates(documents(spark, clashing))
    assert Counter(map(tuple, got.collect())) == expected_exact()


@pytest.mark.parametrize("as_files", [False, True])
def test_dropping_exact_duplicates_keeps_whole_rows(spark, tmp_path, as_files):
    docs = documents(spark, clashing=True)
    if as_files:
        docs = spark.read.parquet(stored(docs, tmp_path / "docs"))
    kept = exact_dedup.drop_exact_duplicates(docs)
    assert kept.columns == docs.columns
    want = Counter({key[0]: n for key, n in expected_exact().items() if key[3]})
    assert Counter(r["doc_id"] for r in kept.collect()) == want


def test_a_third_of_all_rows_may_be_one_text(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'same' ELSE concat('t', id) END AS text")
    got = exact_dedup.exact_duplicates(docs)
    assert got.where("kept").count() == 2001
    assert got.where("keep_id = 0 AND group_size = 1000").count() == 1000


def test_empty_tables(spark):
    none = no_documents(spark)
    assert exact_dedup.exact_duplicates(none).count() == 0
    assert exact_dedup.drop_exact_duplicates(none).count() == 0
    assert simhash.near_duplicates(none).count() == 0
    assert simhash.drop_near_duplicates(none).count() == 0


def plain_fingerprint(text, size=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return 0
    size = min(size, len(words))
    parts = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)]
    hashes = [xxhash.xxh64_intdigest(p.encode(), seed=42) for p in parts]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def expected_near():
    prints = [(doc_id, plain_fingerprint(text)) for doc_id, text, *_ in rows()]
    close = [(i, j) for i in range(len(prints)) for j in range(i + 1) if (prints[i][1] ^ prints[j][1]).bit_count() <= 4]
    root = groups(close)
    lowest = defaultdict(list)
    for i, (doc_id, _) in enumerate(prints):
        lowest[root[i]] += [doc_id] if doc_id is not None else []
    return Counter((doc_id, f"{fp:016x}", min(lowest[root[i]], default=None)) for i, (doc_id, fp) in enumerate(prints))


@pytest.mark.parametrize("clashing", [False, True])
def test_near_duplicates(spark, clashing):
    got = simhash.near_duplicates(documents(spark, clashing))
    assert Counter(map(tuple, got.collect())) == expected_near()


def test_one_row_of_each_near_class_stays(spark):
    docs = documents(spark, clashing=True)
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    classes = {key[2] for key in expected_near()}
    assert Counter(i for i in ids if i is not None) == Counter(c for c in classes if c is not None)
    assert ids.count(None) == 1  # the two equal rows without an id are a class of their own


def test_long_texts_are_hashed_in_steps():
    text = " ".join(str(i % 977) for i in range(simhash._HASHES_AT_ONCE + 5000))
    assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


def test_trees_find_every_pair():
    pick = random.Random(5)
    values = [pick.getrandbits(64) for _ in range(300)]
    values += [v ^ (1 << pick.randrange(64)) ^ (1 << pick.randrange(64)) for v in values for _ in range(2)]
    values = np.array(sorted(set(values)), dtype=np.uint64)
    shard = np.arange(len(values)) * 3 // len(values)
    found = set()
    for query, node in Forest(values, shard).search(values, shard, 4):
        found |= set(zip(query.tolist(), node.tolist()))
    want = {
        (i, j)
        for i in range(len(values))
        for j in range(len(values))
        if shard[i] == shard[j] and (int(values[i]) ^ int(values[j])).bit_count() <= 4
    }
    assert found == want


@pytest.mark.parametrize("shard", [7, 20_000])
def test_cut_shards_lose_no_link(spark, shard):
    pick = random.Random(6)
    centre = pick.getrandbits(64)
    family = {centre}
    while len(family) < 60:  # a chain of near fingerprints that share most blocks
        family.add(pick.choice(sorted(family)) ^ (1 << pick.randrange(20)) ^ (1 << pick.randrange(20)))
    values = sorted(family | {pick.getrandbits(64) for _ in range(40)})
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    prints = spark.createDataFrame([(v,) for v in signed], "fp long")
    got = groups([tuple(r) for r in simhash.links(prints, 4, shard).collect()])
    want = groups([(signed[i], signed[j]) for i in range(len(values)) for j in range(i) if (values[i] ^ values[j]).bit_count() <= 4])
    assert got == want


def test_components(spark):
    pick = random.Random(7)
    links = [(i, i + 1) for i in range(50)] + [(1000, 1000 + i) for i in range(60)]
    links += [(pick.randrange(2000, 2100), pick.randrange(2000, 2100)) for _ in range(60)] + [(5, 5)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {node: root for node, root in groups(links).items() if node != root}
    assert got == want
    assert components(spark.createDataFrame([(None, 1)], "a long, b long")).count() == 0

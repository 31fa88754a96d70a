"""Passages whose lead-in and close vary, against brute force."""

from __future__ import annotations

import random
from collections import defaultdict

from lendspark.llm import suffixes


def test_crossed_variants_are_found(spark):
    pick = random.Random(3)

    def words(n):
        return [f"w{pick.randrange(10**9)}" for _ in range(n)]

    leads, fixed, closes = [words(4) for _ in range(4)], words(44), [words(4) for _ in range(4)]
    texts = [words(20) + pick.choice(leads) + fixed + pick.choice(closes) + words(20) for _ in range(200)]
    holders = defaultdict(set)
    for i, text in enumerate(texts):
        for at in range(len(text) - suffixes.PASSAGE + 1):
            holders[tuple(text[at : at + suffixes.PASSAGE])].add(i)
    want = {}
    for window, ids in holders.items():
        for i in ids if len(ids) > 1 else ():
            at = next(k for k in range(len(texts[i])) if tuple(texts[i][k : k + suffixes.PASSAGE]) == window)
            low, high = want.get(i, (at, at))
            want[i] = (min(low, at), max(high, at))
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    got = suffixes.repeated_passages(df).collect()
    assert sorted((r["doc_id"], r["begin"], r["end"]) for r in got) == sorted((i, a, b + suffixes.PASSAGE) for i, (a, b) in want.items())
    assert all(texts[r["other_id"]] != texts[r["doc_id"]] for r in got)

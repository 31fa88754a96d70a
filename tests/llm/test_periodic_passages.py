"""Passages in texts that repeat a few words on and on."""

import random

import numpy as np
import pytest
from llm_tables import prose
from test_tables import covered

from lendspark.llm import suffixes


@pytest.mark.parametrize("at_once", [5, 1 << 16])
def test_periodic_texts(spark, monkeypatch, at_once):
    monkeypatch.setattr(suffixes, "_ROWS_AT_ONCE", at_once)
    pick, texts = random.Random(21), {}
    for period in (1, 2, 5, 20, 33):
        words = [f"p{period}x{i}" for i in range(period)]
        for copy in range(4):
            turned = words[copy % period :] + words[: copy % period]
            run = (turned * 400)[: pick.randint(45, 260)]
            again = (turned * 400)[: pick.randint(45, 120)]
            parts = [prose(5000 + len(texts), 25).split(), run, prose(6000 + len(texts), pick.randint(1, 70)).split(), again]
            texts[len(texts)] = " ".join(sum(parts, []))
    texts[len(texts)] = "alone " * 300
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    found = {i: np.zeros(len(t.split()), dtype=bool) for i, t in texts.items()}
    for r in suffixes.repeated_passages(df).collect():
        assert r["end"] - r["begin"] >= suffixes.PASSAGE and r["other_id"] != r["doc_id"]
        found[r["doc_id"]][r["begin"] : r["end"]] = True
    want = covered(texts)
    assert all((found[i] == want[i]).all() for i in texts)


@pytest.mark.parametrize("period", [1, 5, 20])
def test_a_periodic_text_has_few_suffixes(period):
    words = np.tile(np.arange(1, period + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), 200_000 // period)
    places, grams = suffixes._selected(words, suffixes._Powers())
    kept, more = suffixes._chains((words >> np.uint64(32)).astype(np.uint32), places, grams)
    assert len(kept) <= 2 * suffixes.PASSAGE
    assert sorted(places[kept]) == list(places[kept]) and (places[kept] + more).max() == places.max()

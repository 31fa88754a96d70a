"""Licence notices, quality, byte BPE and PPM against plain Python."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import tiktoken
from llm_tables import documents, no_documents, prose, rows

from lendspark.llm import blocks, bpe, licenses, ppm, quality

SMALL = str.maketrans({chr(c): chr(c + 32) for c in range(ord("A"), ord("Z") + 1)})


@pytest.mark.parametrize("clashing", [False, True])
def test_license_base_phrases(spark, clashing):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    want = Counter()
    for doc_id, text, *_ in rows():
        words = word.findall((text or "").translate(SMALL))
        starts, labels = [], set()
        for phrase, label in licenses.BASE.items():
            parts = phrase.split()
            places = [i for i in range(len(words)) if words[i : i + len(parts)] == parts]
            starts += places
            labels |= {label} if places else set()
        want[(doc_id, len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels)))] += 1
    got = licenses.summary(licenses.scan(documents(spark, clashing)))
    assert Counter(tuple(r)[:6] for r in got.collect()) == want
    by_id = {r["doc_id"]: r for r in got.collect()}
    assert by_id[12]["labels"] == "apache,cc-by,mit" and by_id[12]["base_labels"] == "cc-by,mit"
    assert by_id[5]["labels"] == "" and by_id[5]["score"] == 0.0 and by_id[11]["score"] == 1.0
    assert licenses.scan(no_documents(spark)).count() == 0


def edits(a: str, b: str) -> int:
    line = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        line, last = [i], line
        for j, y in enumerate(b, 1):
            line.append(min(last[j] + 1, line[-1] + 1, last[j - 1] + (x != y)))
    return line[-1]


@pytest.mark.parametrize("notice", [*licenses.BASE, *licenses.NOTICES])
def test_a_notice_is_found_with_as_many_edits_as_allowed(notice):
    for k in range(licenses.edits_of(notice) + 1):
        changed = list(notice)
        for i in range(k):
            changed[(i * 7 + 3) % len(notice)] = "q"
        text = f"word {''.join(changed)} other words"
        spans = [s for s in licenses.spans_of(text) if s["notice"] == notice]
        assert spans and min(s["edits"] for s in spans) <= edits(notice, "".join(changed))
        assert min(s["first_word"] for s in spans) == 1
    assert licenses.spans_of("nothing of the kind") == []


def test_bpe_round_trip(spark):
    ranks, pattern = bpe.public_tokenizer(spark)
    encoder = tiktoken.Encoding("plain", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    want = Counter()
    for doc_id, text, *_ in rows():
        ids = encoder.encode_ordinary(text or "")
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        want[(doc_id, len(ids), digest, hashlib.sha256((text or "").encode()).hexdigest())] += 1
    assert Counter(map(tuple, bpe.round_trip(documents(spark, True), ranks, pattern).collect())) == want
    assert bpe.round_trip(no_documents(spark), ranks, pattern).count() == 0


def test_bpe_of_many_blocks_and_runs(spark, monkeypatch):
    ranks, pattern = bpe.public_tokenizer(spark)
    encoder = tiktoken.Encoding("plain", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    texts = [(i, prose(i % 7, 40)) for i in range(60)]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(7)
    got = {r["doc_id"]: r["ids"] for r in bpe.encode(df, ranks, pattern).collect()}
    assert got == {i: encoder.encode_ordinary(t) for i, t in texts}


def test_pattern_splits_every_character_as_the_tokenizer_does():
    import public_tokenizers

    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    encoder = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    known = [chr(c) for c in range(0x3000) if not 0xD800 <= c < 0xE000]
    text = "".join(f"a{c}b {c}1{c}{c} " for c in known)
    pieces = bpe._split(public_tokenizers.PATTERN, text.encode())
    assert [i for p in pieces for i in encoder.encode_ordinary(p.decode())] == encoder.encode_ordinary(text)


def test_packs_give_back_what_went_in():
    place = np.array([(2 << 28) | 5, (1 << 28) | 3, (2 << 28) | 1, (1 << 28) | 0], dtype=np.int64)
    size = np.array([2, 0, 1, 3])
    packs = blocks.packed(place, size, np.array([7, 8, 9, 1, 2, 3], dtype=np.int64)).to_pylist()
    assert [p["block"] for p in packs] == [1, 2]
    number = np.cumsum(blocks._unsqueeze(packs[1]["numbers"], np.int32))
    assert number.tolist() == [1, 5]
    assert blocks._unsqueeze(packs[1]["values"], np.int64).tolist() == [9, 7, 8]


def plain_ppm(texts):
    counts = {}
    for text in texts:
        data = [255] * ppm.ORDER + list(text.encode()) + [255]
        for i in range(ppm.ORDER, len(data)):
            for j in range(ppm.ORDER + 1):
                counts.setdefault(tuple(data[i - j : i]), Counter())[data[i]] += 1

    def score(text):
        data, total = [255] * ppm.ORDER + list(text.encode()) + [255], 0.0
        for i in range(ppm.ORDER, len(data)):
            out = set()
            for j in range(ppm.ORDER, -1, -1):
                here = {s: n for s, n in counts.get(tuple(data[i - j : i]), {}).items() if s not in out}
                room = sum(here.values())
                if data[i] in here:
                    total += math.log10((here[data[i]] - 0.5) / room)
                    break
                if here:
                    total += math.log10(len(here) / 2 / room)
                out |= set(counts.get(tuple(data[i - j : i]), {}))
            else:
                total -= math.log10(256 - len(out))
        return total

    return score


@pytest.mark.parametrize("shard_rows", [200, 2_000_000])
def test_ppm_scores(spark, monkeypatch, shard_rows):
    monkeypatch.setattr(ppm, "SHARD_ROWS", shard_rows)
    docs = [r for r in rows() if r[1] is None or len(r[1]) < 5000]
    held = [zlib.crc32(str("" if r[0] is None else r[0]).encode()) % 5 == 1 for r in docs]
    tokens = [[*(r[1] or "").encode().lower().split(), b"\xff"] for r in docs]
    counts = Counter(t for words, out in zip(tokens, held) if not out for t in words)
    total = sum(counts.values())
    score = plain_ppm([r[1] or "" for r, out in zip(docs, held) if not out])
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    got = ppm.score_documents(df.repartition(3)).collect()
    assert len(got) == len(docs)
    found = {(r["doc_id"], r["n_tokens"]): r for r in got}
    for row, out, words in zip(docs, held, tokens):
        r = found[(row[0], len(words))]
        assert (r["held_out"], r["n_known"], r["train_tokens"]) == (out, sum(counts[w] > 0 for w in words), total)
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (len(counts) + 1))) for w in words)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9)
        assert math.isclose(r["score"], score(row[1] or ""), rel_tol=1e-9)


def test_ppm_without_texts(spark):
    assert ppm.score_documents(no_documents(spark)).count() == 0


def test_ppm_probabilities_add_up_to_one(spark):
    texts = spark.createDataFrame([("abracadabra",), ("cabbage",)], "text string")
    model = ppm.load(ppm.shard_files(ppm.train(texts))[0].removeprefix("file:"))
    for context in (b"abra", b"cada", b"zzzz", b"bbag"):
        start = int.from_bytes(context, "big") << 8
        assert math.isclose(sum(10 ** ppm.log_probability(model, start + np.arange(256))), 1.0, rel_tol=1e-9)


def test_quality_separates_junk(spark):
    good = [(i, prose(i, 40 + i % 50)) for i in range(300)]
    bad = [(1000 + i, prose(i, 40).replace(" ", "!! ").upper()) for i in range(60)]
    docs = spark.createDataFrame(good + bad, "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "CAST(doc_id < 1000 AS INT) AS quality", "0 AS toxic")
    got = quality.score(docs, quality.train(docs, labels)).collect()
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    assert held and all(r["predicted"] == (r["doc_id"] < 1000) for r in held)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_an_id_with_a_third_of_all_rows_counts_once(spark):
    table = [(i, prose(i, 30) if i % 2 else "AB!! CD!! " * 20) for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality long")
    once = spark.createDataFrame(table, "doc_id long, text string")
    hot = next(i for i in range(60) if zlib.crc32(str(i).encode()) % 5 and i % 2)
    often = once.unionByName(spark.createDataFrame([(hot, table[hot][1])] * 200, "doc_id long, text string")).repartition(5)
    scores = [[r["score"] for r in quality.score(once, quality.train(df, labels)).orderBy("doc_id").collect()] for df in (once, often)]
    assert scores[0] == scores[1]


def test_quality_of_awkward_tables(spark):
    docs = documents(spark, clashing=True)
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (2, 1, 0), (8, None, None), (None, 1, 0), (13, 0, 0), (9, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality.train(docs, labels)
    assert quality.score(docs, model).count() == docs.count()
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns and kept.count() <= docs.count()
    nothing = quality.train(docs, labels.limit(0))
    assert {r["score"] for r in quality.score(docs, nothing).collect()} == {0.5}
    assert quality.score(no_documents(spark), nothing).count() == 0
    assert quality.keep_good(no_documents(spark), nothing).count() == 0


def test_scores_are_sums_of_table_entries():
    pick = np.random.default_rng(3)
    values = pick.normal(size=(400, 13))
    model = quality.fit(values, (values[:, 0] * values[:, 1] > 0).astype(float))
    row = values[:1]
    total = model.base + sum(t[np.searchsorted(c, row[0, f], side="right")] for f, (c, t) in enumerate(zip(model.cuts, model.tables)))
    coarse = [np.searchsorted(c, row[0, f], side="right") for f, c in enumerate(model.pair_cuts)]
    total += sum(t[coarse[f], coarse[g]] for (f, g), t in zip(model.pairs, model.pair_tables))
    assert math.isclose(model.score(row)[0], 1 / (1 + math.exp(-total)))
    assert (0, 1) in model.pairs or (1, 0) in model.pairs  # the interaction is found

"""Spelling variants against plain Python."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pytest
from llm_tables import DOCS, documents, no_documents, prose, rows
from pyspark.sql import functions as F

from lendspark.llm import spelling

SMALL = str.maketrans({chr(c): chr(c + 32) for c in range(ord("A"), ord("Z") + 1)})


def plain_counts(table):
    n = Counter()
    for doc_id, text in table:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(SMALL)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += len(run) >= 5
    return {word: count for word, count in n.items() if count >= 3}


def near(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_variants(n):
    form, count = {}, {}
    for word in n:
        others = [v for v in n if near(word, v)]
        best = min(((-n[v], v) for v in others), default=(0, None))
        count[word], form[word] = len(others), best[1] if -best[0] >= 2 * n[word] else None

    def root(word):
        return root(form[word]) if form[word] else word

    return sorted((w, form[w], root(w), n[w], count[w], n.get(form[w])) for w in n)


def got(df):
    return sorted(tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in df.collect())


@pytest.mark.parametrize("clashing", [False, True])
def test_documents(spark, clashing):
    docs = documents(spark, clashing).withColumn("word", F.lit("own")).withColumn("n", F.lit("own"))
    n = plain_counts([(r[0], r[1]) for r in rows()])
    assert len(n) > 100
    assert got(spelling.variants(spelling.word_counts(docs))) == plain_variants(n)


def test_thinning_takes_whole_characters_and_words_may_become_too_short(spark):
    text = " ".join(prose(i, 30).replace("ka", "Éka") for i in range(9))
    table = [(i % 40, text + " ×÷ÿ ABCDE abcde") for i in range(120)]
    want = plain_counts(table)
    df = spark.createDataFrame(table, "doc_id long, text string")
    assert {r["word"]: r["n"] for r in spelling.word_counts(df).collect()} == want
    assert want["abcde"] > 200


WORDS = {
    "aaaaa": 3, "aaaaaa": 9, "aaaaaaa": 40, "baaaaa": 5, "aaaaab": 5, "abaaaa": 100, "colour": 50, "color": 100, "colours": 20, "colors": 60,
    "dolor": 100, "velor": 30, "élève": 8, "elève": 4, "élèves": 16, "zzzzz": 3, "zzzzzzzzz": 3, "q" * 70: 3, "q" * 69: 7, "q" * 64: 5, "q" * 65: 11,
    "q" * 66: 30, "q" * 30 + "x" + "q" * 33: 100,
}


def test_runs_of_equal_letters_ties_chains_and_long_words(spark):
    df = spark.createDataFrame(list(WORDS.items()), "word string, n long")
    assert got(spelling.variants(df)) == plain_variants(WORDS)


def test_a_chain_of_forms_ends_at_its_root(spark):
    chain = {"word" + "a" * i: 3 * 2**i for i in range(1, 20)}
    df = spark.createDataFrame(list(chain.items()), "word string, n long")
    assert {r["root"] for r in spelling.variants(df).collect()} == {"word" + "a" * 19}
    assert got(spelling.variants(df)) == plain_variants(chain)


def test_no_group_grows_with_the_number_of_words(spark):
    hub = "abcdefgh"
    words = {hub[:i] + c + hub[i + k :] for i in range(9) for k in (0, 1) for c in "abcdefghijklmnopqrstuvwxyz"} | {hub}
    df = spark.createDataFrame([(w, 3 + len(w) % 3) for w in words], "word string, n long")
    assert got(spelling.variants(df)) == plain_variants({w: 3 + len(w) % 3 for w in words})
    assert spelling._entries(df).groupBy("key").count().agg(F.max("count")).first()[0] <= 27


def test_empty_tables(spark):
    assert spelling.word_counts(no_documents(spark)).count() == 0
    assert spelling.variants(spark.createDataFrame([], "word string, n long")).count() == 0
    nothing = spark.createDataFrame([(1, None, None, None, None), (None, "", None, None, None)], DOCS)
    assert spelling.word_counts(nothing).count() == 0

from __future__ import annotations

import random

import duckdb
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lendspark.functions.similarity import jaro_winkler, may_reach, meets, with_index_keys, with_letter_bits, with_probe_keys
from lendspark.operators import resolve

FLOOR = 0.92
FIRST = "tarek nadia jamil samira bilal huda karim leena faris dalia bassam rania idris salma".split()
LAST = "haddad,al zaabi,qureshi,darwish,menon,al ketbi,farouk,mirza,khoury,al suwaidi".split(",")


def misspelt(rng: random.Random) -> str:
    letters = list(f"{rng.choice(FIRST)} {rng.choice(LAST)}")
    for _ in range(rng.randint(0, 3)):
        at = rng.randrange(len(letters))
        kind = rng.random()
        if kind < 0.3:
            letters[at] = rng.choice("abcdefgh é")
        elif kind < 0.6 and len(letters) > 1:
            letters.pop(at)
        else:
            letters.insert(at, rng.choice("abcdefgh"))
    return "".join(letters)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.text("abcde ", min_size=1, max_size=12), st.text("abcde ", min_size=1, max_size=12)), min_size=1))
def test_same_as_duckdb(pairs):
    frame = pd.DataFrame(pairs, columns=["a", "b"])
    expected = duckdb.sql("SELECT jaro_winkler_similarity(a, b) AS s FROM frame").df()["s"]
    assert (jaro_winkler(frame["a"], frame["b"]) - expected).abs().max() < 1e-12


@pytest.mark.parametrize(
    ("left", "right", "score"),
    [("bassem al zaabi", "bassam al zaabi", 0.9304), ("martha", "marhta", 0.9611), ("dixon", "dicksonx", 0.8133), ("abc", "xyz", 0.0)],
)
def test_known_values(left, right, score):
    got = jaro_winkler(pd.Series([left]), pd.Series([right]))[0]
    assert got == pytest.approx(score, abs=1e-4)


def test_blocking_keys_lose_no_similar_pair(spark):
    """All names share one birth date; every pair at or above the floor must meet under some key."""
    rng = random.Random(11)
    left = sorted({misspelt(rng) for _ in range(700)} | {"a", "ab", "abc", "é"})
    right = sorted({misspelt(rng) for _ in range(700)} | {"a", "ab", "abd", "é"})
    grid = pd.MultiIndex.from_product([left, right]).to_frame(index=False, name=["a", "b"])
    scores = jaro_winkler(grid["a"], grid["b"])
    similar = set(grid[scores >= FLOOR].itertuples(index=False, name=None))
    assert len(similar) > 500

    probes = with_probe_keys(spark.createDataFrame([("d", n) for n in left], "dob string, a string"), "dob", "a", FLOOR)
    index = with_index_keys(spark.createDataFrame([("d", n) for n in right], "dob string, b string"), "dob", "b", FLOOR)
    met = probes.join(index, ["key", "dob", "prefix"]).where(meets("a", "b", "prefix")).select("a", "b").distinct()
    met_pairs = {(r["a"], r["b"]) for r in met.collect()}
    assert similar <= met_pairs
    assert len(met_pairs) < len(grid) / 5


@pytest.mark.parametrize("direct", [0, 100, 10_000])
def test_strong_pairs_equal_brute_force(spark, monkeypatch, direct):
    monkeypatch.setattr(resolve, "DIRECT_NAMES", direct)
    rng = random.Random(5)
    names = lambda: sorted({(rng.choice(["d1", "d2"]), misspelt(rng)) for _ in range(250)})
    left, right = names(), names()
    pairs = resolve.strong_name_pairs(
        spark.createDataFrame(left, "dob string, name string"), spark.createDataFrame(right, "dob string, name string")
    )
    got = {(r["dob"], r["name"], r["known_name"]) for r in pairs.collect()}
    want = set()
    for dob, name in left:
        block = pd.Series([n for d, n in right if d == dob])
        scores = jaro_winkler(pd.Series([name] * len(block)), block)
        want |= {(dob, name, other) for other in block[scores >= FLOOR]}
    assert got == want


def test_few_names_on_one_date_with_one_beginning_are_scored(spark):
    """Of unlike names that all begin alike, the filters before the scoring leave a small part of all pairs."""
    rng = random.Random(8)
    letters = "abcdefghijklmnopqrstuvwxyz"
    names = {"maria " + "".join(rng.choice(letters) for _ in range(rng.randint(6, 12))) for _ in range(600)}
    df = spark.createDataFrame([("d", n) for n in sorted(names)], "dob string, name string")
    probes = with_probe_keys(with_letter_bits(df, "name", "x"), "dob", "name", FLOOR)
    known = with_letter_bits(df.withColumnRenamed("name", "known"), "known", "y")
    met = probes.join(with_index_keys(known, "dob", "known", FLOOR), ["key", "dob", "prefix"]).where(meets("name", "known", "prefix"))
    assert met.count() < len(names) ** 2
    left = met.where(may_reach("name", "known", "x", "y", FLOOR)).select("name", "known").distinct().count()
    assert left < len(names) ** 2 / 20


def test_low_floors_are_refused(spark):
    names = spark.createDataFrame([("d", "x")], "dob string, name string")
    with pytest.raises(ValueError):
        with_index_keys(names, "dob", "name", 0.7)


def test_pairs_are_scored_once(spark):
    names = spark.createDataFrame([("d", "karim haddad")], "dob string, name string")
    pairs = resolve.strong_name_pairs(names, names).select("score").where(F.col("score") > 0)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_names_dealt_into_parts_lose_no_pair(spark, monkeypatch):
    rng = random.Random(11)
    names = spark.createDataFrame([("d", n) for n in sorted({misspelt(rng) for _ in range(120)})], "dob string, name string")
    whole = {(r["name"], r["known_name"]) for r in resolve.strong_name_pairs(names, names).collect()}
    monkeypatch.setattr(resolve, "DIRECT_PAIRS", 700)
    assert [(r["name"], r["known_name"]) for r in resolve.strong_name_pairs(names, names).orderBy("name", "known_name").collect()] == sorted(whole)


def test_letter_bits_need_no_function_per_letter(spark):
    """Functions over arrays are interpreted and were repeated for every letter: some 200 microseconds a name."""
    df = with_letter_bits(spark.createDataFrame([("aabbbé", "aab")], "left string, right string"), "left", "x")
    assert "lambda" not in df._jdf.queryExecution().optimizedPlan().toString()
    bits = df.first()["x"]
    assert (bin(bits["bits"]).count("1"), bits["rest"]) == (4, 2)

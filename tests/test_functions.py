from __future__ import annotations

import hashlib
import json
import random
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from lendspark.functions import canonical, text


def evaluate(spark, expression, value, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(expression(F.col("c")).alias("r")).head()[0]


@pytest.mark.parametrize(
    ("given", "expected"),
    [("17061988", "1988-06-17"), ("31021988", "31021988"), ("n/a", "n/a"), ("1234567", "1234567"), (None, ""), ("", "")],
)
def test_birth_dates(spark, given, expected):
    assert evaluate(spark, text.birth_date_to_iso, given) == expected


def test_other_dates_keep_null(spark):
    assert evaluate(spark, text.compact_date_to_iso, None) is None


@pytest.mark.parametrize(
    ("given", "expected"),
    [("1.5", 1.5), (" 2 ", 2.0), ("1e3", 1000.0), ("abc", 0.0), ("5d", 0.0), ("", 0.0), (None, 0.0), ("-.5", -0.5)],
)
def test_floats(spark, given, expected):
    assert evaluate(spark, text.float_or_zero, given) == expected


@pytest.mark.parametrize(("given", "expected"), [("7", 7), (" 7 ", 7), ("727.0", None), ("x", None), (None, None)])
def test_integers(spark, given, expected):
    assert evaluate(spark, text.int_or_null, given) == expected


@pytest.mark.parametrize(
    ("given", "expected"),
    [("784-1990-1234567-1", True), ("784-1990-123456-1", False), ("x784-1990-1234567-1", False), ("", False), (None, False)],
)
def test_valid_eid(spark, given, expected):
    assert evaluate(spark, text.valid_eid, given) is expected


def test_normalised_eid(spark):
    assert evaluate(spark, text.normalise_eid, "\t784-1990-abc \n") == "784-1990-ABC"
    assert evaluate(spark, text.normalise_eid, "  ") is None


@pytest.mark.parametrize(
    ("given", "expected"),
    [("2024-02-29", "2024-02-29"), ("2023-02-29", None), ("20240229", "2024-02-29"), ("2024-02-29T10:00:00", "2024-02-29"),
     ("31021988", None), ("soon", None), ("", None), (None, None)],
)
def test_iso_dates(spark, given, expected):
    got = evaluate(spark, text.iso_date, given)
    assert (None if got is None else str(got)) == expected


def test_ages_round_down_and_toward_zero(spark):
    row = spark.sql(
        "SELECT timestamp'2024-02-01 00:00:00' AS now, timestamp'2024-01-31 00:00:01' AS past, timestamp'2024-02-01 00:00:01.5' AS ahead"
    ).select(
        text.whole_days_between(F.col("now"), F.col("past")).alias("days"),
        text.whole_days_between(F.col("now"), F.col("ahead")).alias("days_ahead"),
        text.whole_seconds_between(F.col("now"), F.col("ahead")).alias("seconds_ahead"),
    ).head()
    assert (row["days"], row["days_ahead"], row["seconds_ahead"]) == (0, -1, -1)


def test_pii_token(spark):
    expected = "tok_" + hashlib.sha256("bassam al zaabi".encode()).hexdigest()[:16]
    assert evaluate(spark, text.pii_token, "  Bassam Al ZAABI ") == expected
    assert evaluate(spark, text.pii_token, None) is None


def test_canonical_json_is_sorted_compact_and_keeps_nulls(spark):
    row = spark.createDataFrame([("é", None, ["x"])], "b string, a int, c array<string>")
    shown = row.select(canonical.canonical_json({n: F.col(n) for n in ("b", "a", "c")})).head()[0]
    assert shown == '{"a":null,"b":"é","c":["x"]}'


def test_lists_survive_text(spark):
    df = spark.createDataFrame([(["a", "b"],), ([],), (None,)], "l array<string>")
    back = df.select(canonical.list_from_json(canonical.list_to_json(F.col("l"))).alias("l")).collect()
    assert [r["l"] for r in back] == [["a", "b"], [], []]
    assert evaluate(spark, canonical.list_from_json, "") == []


def test_iso_timestamp_does_not_depend_on_the_session_zone(spark):
    stamp = spark.createDataFrame([(datetime(2026, 4, 18, 12, 21, 37, 5, tzinfo=timezone.utc),)], "t timestamp")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Dubai")
        assert stamp.select(text.iso_timestamp(F.col("t"))).head()[0] == "2026-04-18T12:21:37.000005+00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_numbers_are_written_as_python_writes_them(spark):
    pick = random.Random(5)
    values = [0.0, -0.0, 1.0, -1.5, 0.1, 1e-7, 1e-5, 9.999e-5, 1e-4, 0.00012345, 1e7, 12345678.9, 1e15, 123456789012345680.0, 1e16, 1e17, 1e22, 1e23]
    values += [2.0**-44, 1.7976931348623157e308, 100.0, 1e100, -2.5e-10, 0.3, 2 / 3]
    values += [round(pick.uniform(-1e9, 1e9), 2) for _ in range(200)] + [pick.random() * 10.0 ** pick.randint(-7, 17) for _ in range(300)]
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in rows.select(canonical.number_text(F.col("v"))).collect()]
    wrong = [(v, text) for v, text in zip(values, got) if text != repr(v)]
    assert [x for x in wrong if len(repr(x[0]).strip("-").replace(".", "").partition("e")[0].strip("0")) < 17] == []
    assert all(float(text) == v for v, text in wrong) and len(wrong) <= 5  # before Java 19 some texts of 17 digits end differently
    special = spark.createDataFrame([(None,), (float("nan"),), (float("inf"),), (float("-inf"),)], "v double")
    assert [r[0] for r in special.select(canonical.number_text(F.col("v"))).collect()] == ["null", "NaN", "Infinity", "-Infinity"]


def test_canonical_json_hashes_like_python(spark):
    rows = [("é\u2028 \"x\\", 1e7, -0.0, None, [], True, 3), (None, 1e-7, 1e17, 40000.0, ["b", "ß"], False, None)]
    names = ("text", "big", "zero", "none", "list", "flag", "number")
    df = spark.createDataFrame(rows, "text string, big double, zero double, none double, list array<string>, flag boolean, number int")
    fields = {n: F.col(n) for n in names}
    got = df.select(canonical.sha256(canonical.canonical_json(fields, doubles=("big", "zero", "none")))).collect()
    for row, (digest,) in zip(rows, got):
        text = json.dumps(dict(zip(names, row)), sort_keys=True, separators=(",", ":"), ensure_ascii=False)
        assert digest == hashlib.sha256(text.encode()).hexdigest()


def test_digits_of_a_number_are_searched_for_once(spark):
    shown = spark.range(1).select(canonical.number_text(F.col("id").cast("double")).alias("text"))
    assert shown._jdf.queryExecution().analyzed().toString().count("format_string(") <= 5  # one text each of 17, 16 and 15 digits


def test_a_whole_object_needs_no_cutting(spark):
    df = spark.createDataFrame([(1e7, 40000.0, -0.0, None, 2.5), (9999999.0, 3.0, 0.0, -7.0, 1e-9)], "a double, b double, c double, d double, z double")
    for doubles in (("a", "b", "c", "d"), ("b", "c", "d"), ("z",), ("a", "b", "c", "d", "z")):
        got = [r[0] for r in df.select(canonical.canonical_json({n: F.col(n) for n in doubles}, doubles=doubles)).collect()]
        assert got == [json.dumps({n: r[n] for n in doubles}, sort_keys=True, separators=(",", ":")) for r in df.collect()]

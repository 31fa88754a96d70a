from __future__ import annotations

import json

import pytest
from builders import KNOWN_EID, aml, bureau, fraud, one, profiles
from pyspark.sql import functions as F

from lendspark.operators import conflicts, resolve, skew, vectors


def only(spark, as_of, source, row):
    """The resolver's answer for one record of one source."""
    empty = {"aecb": bureau(spark, []), "fraud": fraud(spark, []), "aml": aml(spark, [])}
    make = {"aecb": bureau, "fraud": fraud, "aml": aml}[source]
    silver = {"profile": profiles(spark)} | empty | {source: make(spark, [row])}
    return one(resolve.resolve(silver).where(F.col("source") == source))


CASES = [
    ("aecb", {"emirates_id": KNOWN_EID}, "eid_exact", KNOWN_EID, 1.0),
    ("aecb", {"emirates_id": "784-2001-7770001-3"}, "eid_exact", "784-2001-7770001-3", 1.0),
    ("fraud", {"emirates_id": "784-no-number"}, "quarantine", "784-no-number", 0.0),
    ("fraud", {"emirates_id": "784-2090-1112223-4"}, "quarantine", "784-2090-1112223-4", 0.0),
    ("aml", {"emirates_id": "784-2091-4445556-7"}, "quarantine", "784-2091-4445556-7", 0.0),
    ("fraud", {"phone": "+971552468013", "email": "BASSAM.Z@post.example"}, "phone_email_exact", KNOWN_EID, 0.95),
    ("fraud", {"phone": "+971552468013"}, "quarantine", "", 0.0),
    ("fraud", {"phone": "+971552468013", "email": ""}, "quarantine", "", 0.0),
    ("aml", {"full_name": "BASSAM Al Zaabi", "dob": "1979-11-03"}, "name_dob_fuzzy", KNOWN_EID, 1.0),
    ("aml", {"full_name": "Bassem Al Zaabi", "dob": "1979-11-03"}, "name_dob_fuzzy", KNOWN_EID, 0.93),
    ("aml", {"full_name": "Bassam Al Zaabi", "dob": "1981-06-06"}, "quarantine", "", 0.0),
    ("aml", {"full_name": "Nobody Of That Kind", "dob": "1979-11-03"}, "quarantine", "", 0.0),
    ("aecb", {"emirates_id": "bad", "full_name": "BASSAM AL ZAABI", "dob": "1979-11-03"}, "name_dob_fuzzy", KNOWN_EID, 1.0),
]


def test_tiers(spark, as_of):
    """Every case at once; the position in its feed tells the records apart."""
    rows = {"aecb": [], "fraud": [], "aml": []}
    for source, row, *_ in CASES:
        rows[source].append(row)
    silver = {"profile": profiles(spark), "aecb": bureau(spark, rows["aecb"]), "fraud": fraud(spark, rows["fraud"]), "aml": aml(spark, rows["aml"])}
    resolved = resolve.resolve(silver)
    found = {(r["source"], r["position"]["row"]): r for r in resolved.collect()}
    assert len(found) == len(CASES) + 2
    at = {"aecb": 0, "fraud": 0, "aml": 0}
    for source, row, tier, eid, confidence in CASES:
        got = found[(source, at[source])]
        at[source] += 1
        assert (got["match_tier"], got["resolved_eid"]) == (tier, eid), row
        assert got["confidence"] == pytest.approx(confidence)
    links = resolve.links(resolved, as_of)
    lost = resolve.quarantine(resolved, silver, as_of)
    assert links.count() + lost.count() == len(CASES) + 2
    body = json.loads(lost.where(F.col("emirates_id") == "784-no-number").head()["source_record"])
    assert body["provider_ref"] == "f" and body["score"] == 100 and "raw_path" not in body


def test_notes(spark, as_of):
    assert only(spark, as_of, "aecb", {"emirates_id": "784-2001-7770001-3"})["notes"].startswith("new customer")
    assert only(spark, as_of, "aml", {"full_name": "Bassem Al Zaabi", "dob": "1979-11-03"})["notes"] == (
        "jaro-winkler=0.930, backfilled emirates_id"
    )


def person(i, name, **more):
    return {"internal_uuid": f"u{i}", "emirates_id": f"784-1990-000000{i}-0", "full_name": name, "dob": "1979-11-03",
            "phone": f"+{i}", "email": f"{i}@e"} | more


@pytest.mark.parametrize(
    ("names", "tier"),
    [
        (["Omar Khan", "Omar Khan"], "quarantine"),  # shared exactly
        (["Omar Khan", "Omar Khann"], "quarantine"),  # two alike
        (["Omar Khann", "Omar Khann"], "quarantine"),  # shared by two, alike
        (["Omar Khan", "Layla Sharma"], "name_dob_fuzzy"),
    ],
)
def test_ambiguous_names_are_quarantined(spark, names, tier):
    known = profiles(spark, [person(i, n) for i, n in enumerate(names)])
    silver = {"profile": known, "aml": aml(spark, [{"full_name": "omar khan", "dob": "1979-11-03"}])}
    assert one(resolve.resolve(silver).where(F.col("source") == "aml"))["match_tier"] == tier


def test_last_profile_with_a_phone_and_email_wins(spark):
    known = profiles(spark, [person(1, "A", phone="+9", email="x@e"), person(2, "B", phone="+9", email="X@e")])
    silver = {"profile": known, "fraud": fraud(spark, [{"phone": "+9", "email": "x@E"}])}
    got = one(resolve.resolve(silver).where(F.col("source") == "fraud"))
    assert got["resolved_eid"] == "784-1990-0000002-0"


def test_profiles_without_a_valid_id_stay_links(spark, as_of):
    known = profiles(spark, [person(1, "A", emirates_id="BAD")])
    resolved = resolve.resolve({"profile": known})
    assert resolve.links(resolved, as_of).count() == 1


def test_a_hot_id_is_spread_and_nothing_is_lost(spark):
    """A third of all records share one ID; the balanced lookup equals the plain join."""
    left = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("key"), "id"
    )
    right = spark.range(400).select(F.concat(F.lit("k"), F.col("id")).alias("key"), F.col("id").alias("value"))
    right = right.unionByName(spark.createDataFrame([("hot", -1)], "key string, value bigint"))
    for how in ("inner", "left"):
        found, plain = skew.lookup(left, right, ["key"], how), left.join(right, ["key"], how)
        assert found.columns == plain.columns
        assert sorted(map(tuple, found.fillna(-9).collect())) == sorted(map(tuple, plain.fillna(-9).collect()))
    assert skew.small(right, 401).hint is not None and skew.small(right, 10).count() == right.count()


def test_backfilled_id_reaches_the_vectors(spark, as_of):
    report = {"emirates_id": None, "full_name": "BASSAM AL ZAABI", "dob": "1979-11-03", "credit_score": 777}
    silver = {"profile": profiles(spark), "aecb": bureau(spark, [report]), "fraud": fraud(spark, []), "aml": aml(spark, [])}
    mine = F.col("emirates_id") == KNOWN_EID
    plain = vectors.assemble(silver, as_of, products=("bnpl",)).where(mine)
    assert one(plain)["credit_score"] is None
    filled = vectors.assemble(silver, as_of, products=("bnpl",), resolved=resolve.resolve(silver)).where(mine)
    assert one(filled)["credit_score"] == 777 and one(filled)["aecb_available"] is True


def test_conflicts_follow_precedence(spark, as_of):
    silver = {
        "profile": profiles(spark),
        "aecb": bureau(spark, [{"emirates_id": KNOWN_EID, "full_name": "  bassam AL zaabi ", "dob": "1979-11-04"}]),
        "fraud": fraud(
            spark,
            [{"emirates_id": KNOWN_EID, "phone": "+999", "email": "BASSAM.Z@POST.EXAMPLE"},
             {"emirates_id": KNOWN_EID, "phone": "+000", "email": "later@e"}],
        ),
        "aml": aml(spark, [{"emirates_id": KNOWN_EID, "full_name": "Bassem", "dob": ""}]),
    }
    found = {
        (r["field"], r["winning_source"], r["winning_value"], r["losing_source"], r["losing_value"])
        for r in conflicts.detect_conflicts(silver, as_of).collect()
    }
    assert found == {
        ("phone", "profile", "+971552468013", "fraud", "+999"),
        ("full_name", "profile", "Bassam Al Zaabi", "aml", "Bassem"),
        ("dob", "profile", "1979-11-03", "aecb", "1979-11-04"),
    }


def test_next_source_wins_where_the_profile_is_silent(spark, as_of):
    known = profiles(spark, [person(1, None, dob="1979-11-03")])
    eid = "784-1990-0000001-0"
    silver = {
        "profile": known, "fraud": fraud(spark, []),
        "aecb": bureau(spark, [{"emirates_id": eid, "full_name": "A", "dob": "1979-11-03"}]),
        "aml": aml(spark, [{"emirates_id": eid, "full_name": "B", "dob": "1979-11-03"}]),
    }
    row = one(conflicts.detect_conflicts(silver, as_of))
    assert (row["winning_source"], row["losing_source"], row["losing_value"]) == ("aecb", "aml", "B")

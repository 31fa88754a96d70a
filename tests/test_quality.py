from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pytest
from builders import KNOWN_EID, aml, bureau, fraud, one, profiles
from pyspark.sql import functions as F

from lendspark import schemas
from lendspark.operators import quality, reports
from lendspark.sources.files import read_table

LINK = "source string, source_event_id string, emirates_id string"


def links(spark, n):
    return spark.range(n).select(F.lit("aml").alias("source"), F.col("id").cast("string").alias("source_event_id"), F.lit("").alias("emirates_id"))


def tables(spark, **given):
    base = {
        "profile": profiles(spark), "fraud": fraud(spark, []), "aml": aml(spark, []),
        "aecb": bureau(spark, [{"emirates_id": KNOWN_EID}]),
        "er_links": links(spark, 0), "er_quarantine": links(spark, 0),
    }
    return base | given


def score(spark, as_of, rule_id, **given):
    rules = [r for r in quality.RULES if r.rule_id == rule_id]
    row = one(quality.scorecard(tables(spark, **given), as_of, "run", rules))
    return row["checked"], row["failed"], row["breached"], row["status"]


def people(spark, *rows):
    return profiles(spark, [{"internal_uuid": f"u{i}", **r} for i, r in enumerate(rows)])


def test_eid_format(spark, as_of):
    assert score(spark, as_of, "eid_format") == (2, 0, False, "PASS")
    dirty = people(spark, {"emirates_id": None}, {"emirates_id": KNOWN_EID}, {"emirates_id": "not-an-eid"})
    assert score(spark, as_of, "eid_format", profile=dirty) == (3, 2, True, "FAIL")


def test_fraud_score_range(spark, as_of):
    rows = fraud(spark, [{"score": s} for s in (2000, 500, -10, 0, 1000, None)])
    assert score(spark, as_of, "fraud_score_range", fraud=rows) == (6, 3, True, "FAIL")
    texts = spark.createDataFrame([("high",), ("7",)], "score string")
    assert score(spark, as_of, "fraud_score_range", fraud=texts)[:2] == (2, 1)
    assert score(spark, as_of, "fraud_score_range") == (0, 0, False, "PASS")


def test_aml_status(spark, as_of):
    assert score(spark, as_of, "aml_status_enum", aml=aml(spark, [{"status": s} for s in ("CLEAR", "REVIEW", "HIT")])) == (3, 0, False, "PASS")
    assert score(spark, as_of, "aml_status_enum", aml=aml(spark, [{"status": "PENDING"}, {"status": None}])) == (2, 2, True, "FAIL")


def test_birth_dates(spark, as_of):
    dobs = ("1990-05-15", "1900-01-01", "2008-04-20", "2008-04-21", "2020-01-01", "1850-01-01", "soon", None)
    rows = people(spark, *[{"dob": d} for d in dobs])
    assert score(spark, as_of, "profile_dob_plausible", profile=rows) == (8, 5, True, "FAIL")


def test_adulthood_on_a_leap_day(spark):
    leap = datetime(2024, 2, 29, tzinfo=timezone.utc)
    rows = people(spark, {"dob": "2006-02-28"}, {"dob": "2006-03-01"})
    assert score(spark, leap, "profile_dob_plausible", profile=rows)[:2] == (2, 1)


def test_bureau_freshness(spark, as_of):
    days = [(as_of - timedelta(days=d)).date().isoformat() for d in (0, 30, 31)]
    rows = bureau(spark, [{"report_date": d} for d in [*days, None, "?"]])
    assert score(spark, as_of, "aecb_freshness_30d", aecb=rows) == (5, 3, True, "FAIL")


def test_no_bureau_data_is_a_breach(spark, as_of):
    assert score(spark, as_of, "aecb_freshness_30d", aecb=bureau(spark, [])) == (0, 1, True, "FAIL")


@pytest.mark.parametrize(("screened", "failed", "breached"), [(97, 3, False), (95, 5, False), (80, 20, True)])
def test_aml_coverage(spark, as_of, screened, failed, breached):
    rows = people(spark, *[{"emirates_id": f"e{i}"} for i in range(100)])
    seen = aml(spark, [{"emirates_id": f"e{i}"} for i in range(screened)] * 2 + [{"emirates_id": None}])
    assert score(spark, as_of, "aml_coverage", profile=rows, aml=seen)[:3] == (100, failed, breached)


def test_fraud_phone_conflict(spark, as_of):
    good = {"emirates_id": KNOWN_EID, "phone": "+971552468013"}
    rows = fraud(spark, [good] * 8 + [good | {"phone": "+0"}] * 2 + [{"emirates_id": "unknown", "phone": "+0"}, {"emirates_id": None}])
    assert score(spark, as_of, "fraud_phone_conflict", fraud=rows) == (10, 2, True, "WARN")
    assert score(spark, as_of, "fraud_phone_conflict") == (0, 0, False, "PASS")


@pytest.mark.parametrize(("kept", "lost", "breached"), [(100, 1, False), (80, 20, True), (0, 0, False)])
def test_quarantine_rate(spark, as_of, kept, lost, breached):
    got = score(spark, as_of, "er_quarantine_rate", er_links=links(spark, kept), er_quarantine=links(spark, lost))
    assert got[:3] == (kept + lost, lost, breached)


def test_samples_are_the_first_three_by_key(spark, as_of):
    rows = fraud(spark, [{"provider_ref": f"f{i}", "score": -i} for i in range(9, 0, -1)])
    card = quality.scorecard(tables(spark, fraud=rows), as_of, "run")
    shown = one(card.where("rule_id = 'fraud_score_range'"))["sample_failures"]
    assert [f"f{i}" in shown for i in (1, 2, 3, 4)] == [True, True, True, False]
    assert one(card.where("rule_id = 'eid_format'"))["sample_failures"] == "[]"
    assert card.count() == len(quality.RULES)


def test_own_rules_can_be_added(spark, as_of):
    rule = quality.RowRule("has_phone", quality.WARN, "profile", "Phone present.", lambda as_of: F.col("phone").isNull())
    card = quality.scorecard(tables(spark), as_of, "run", (*quality.RULES, rule))
    assert one(card.where("rule_id = 'has_phone'"))["status"] == "PASS"


def test_gate(spark, as_of):
    clean = quality.scorecard(tables(spark), as_of, "run")
    quality.gate(clean)
    assert one(quality.verdict(clean))["promoted"] is True
    dirty = quality.scorecard(tables(spark, aecb=bureau(spark, []), fraud=fraud(spark, [{"score": -1}])), as_of, "run")
    with pytest.raises(quality.GateError, match="aecb_freshness_30d, fraud_score_range"):
        quality.gate(dirty)
    assert one(quality.verdict(dirty))["rule_ids"] == "aecb_freshness_30d, fraud_score_range"


def test_results_are_replaced_per_run(spark, as_of, tmp_path):
    path = str(tmp_path / "dq")
    first = quality.scorecard(tables(spark), as_of, "r1")
    for results in (first, quality.scorecard(tables(spark), as_of + timedelta(days=1), "r2"), first):
        quality.persist(results, path)
    stored = read_table(spark, path, schemas.DQ_RESULT)
    assert {(r["run_id"], r["count"]) for r in stored.groupBy("run_id").count().collect()} == {("r1", 8), ("r2", 8)}
    latest = reports.latest_dq_run(stored).collect()
    assert {r["run_id"] for r in latest} == {"r2"}
    assert [(r["severity"], r["rule_id"]) for r in latest] == sorted((r["severity"], r["rule_id"]) for r in latest)
    summary = one(reports.dq_summary(reports.latest_dq_run(stored)))
    assert summary["rules"] == 8 and summary["must_pass_failures"] == 0
    assert reports.dq_display(stored).where("rule_id = 'aml_coverage'").head()["threshold"] == "5.0%"
    assert reports.breached_rules(stored).columns == ["rule_id", "severity", "sample_failures"]

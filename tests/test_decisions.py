from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pytest
from builders import KNOWN_EID, aml, bureau, fraud, one, profiles, vectors
from pyspark.sql import functions as F

from lendspark.operators import decisions, keyed, packs, reports
from lendspark.operators import vectors as assembly

APPROVED = ("APPROVE", ["ALL_CHECKS_PASSED"])
CASES = [
    ("personal_finance", {}, *APPROVED),
    ("personal_finance", {"had_overdue_before": True}, "DECLINE", ["INTERNAL_OVERDUE_HISTORY"]),
    ("personal_finance", {"is_new_user": True}, "REFER", ["NEW_USER_ON_PLATFORM"]),
    ("personal_finance", {"credit_score": None}, "DECLINE", ["CREDIT_SCORE_BELOW_650"]),
    ("personal_finance", {"credit_score": 650}, *APPROVED),
    ("personal_finance", {"credit_score": 649}, "DECLINE", ["CREDIT_SCORE_BELOW_650"]),
    ("personal_finance", {"num_bounced_cheques": 1}, "DECLINE", ["BOUNCED_CHEQUE_HISTORY"]),
    ("personal_finance", {"gross_annual_income": 59999.99}, "DECLINE", ["INCOME_BELOW_60000"]),
    ("personal_finance", {"gross_annual_income": None}, *APPROVED),
    ("personal_finance", {"kyc_age_days": 59}, "REFER", ["KYC_TOO_NEW"]),
    ("personal_finance", {"fraud_score": 401}, "REFER", ["FRAUD_SCORE_ABOVE_400"]),
    ("personal_finance", {"fraud_score": None, "fraud_decision": None}, *APPROVED),
    ("personal_finance", {"aml_available": False, "aml_status": None, "fraud_decision": "REVIEW"}, "REFER", ["AML_PENDING", "FRAUD_REVIEW"]),
    ("personal_finance", {"aecb_available": False}, "REFER", ["AECB_MISSING"]),
    ("personal_finance",
     {"aml_status": "HIT", "fraud_decision": "FAIL", "payment_order_flag": True, "num_bounced_cheques": 3, "num_open_court_cases": 1},
     "DECLINE", ["AML_HIT", "FRAUD_FAIL", "MULTIPLE_BOUNCED_CHEQUES", "OPEN_COURT_CASE"]),
    ("personal_finance", {"payment_order_flag": False, "num_bounced_cheques": 3}, "DECLINE", ["BOUNCED_CHEQUE_HISTORY"]),
    ("bnpl", {"aecb_available": False, "credit_score": None}, *APPROVED),
    ("bnpl", {"aml_available": False, "aml_status": None}, "REFER", ["AML_PENDING"]),
    ("bnpl", {"aml_status": "REVIEW", "fraud_score": 900}, "REFER", ["AML_REVIEW"]),
    ("bnpl", {"fraud_score": 601, "credit_score": 100}, "REFER", ["FRAUD_SCORE_ABOVE_600"]),
    ("bnpl", {"credit_score": 549}, "DECLINE", ["CREDIT_SCORE_BELOW_550"]),
    ("bnpl", {"credit_score": None}, *APPROVED),
    ("bnpl", {"num_bounced_cheques": 2}, "DECLINE", ["MULTIPLE_BOUNCED_CHEQUES"]),
    ("bnpl", {"fraud_decision": "REVIEW"}, "REFER", ["FRAUD_REVIEW"]),
    ("bnpl", {"had_overdue_before": True, "kyc_age_days": 0}, *APPROVED),
    ("credit_card_alt", {"aecb_available": False, "credit_score": None}, "REFER", ["AECB_MISSING"]),
    ("credit_card_alt", {"credit_score": 599}, "DECLINE", ["CREDIT_SCORE_BELOW_600"]),
    ("credit_card_alt", {"credit_score": None}, *APPROVED),
    ("credit_card_alt", {"num_bounced_cheques": 2}, "DECLINE", ["MULTIPLE_BOUNCED_CHEQUES"]),
    ("credit_card_alt", {"kyc_age_days": 29}, "REFER", ["KYC_TOO_NEW"]),
    ("credit_card_alt", {"fraud_score": 501}, "REFER", ["FRAUD_SCORE_ABOVE_500"]),
    ("credit_card_alt", {"aml_status": "REVIEW", "fraud_decision": "REVIEW"}, "REFER", ["AML_REVIEW", "FRAUD_REVIEW"]),
    ("credit_card_alt", {"num_open_court_cases": 1}, "DECLINE", ["OPEN_COURT_CASE"]),
]


def test_packs(spark, as_of):
    rows = [change | {"product": product, "emirates_id": str(i)} for i, (product, change, *_) in enumerate(CASES)]
    decided = {int(r["emirates_id"]): r for r in decisions.decide(vectors(spark, rows), as_of, "run").collect()}
    for i, (product, change, outcome, reasons) in enumerate(CASES):
        assert (decided[i]["outcome"], decided[i]["reason_codes"]) == (outcome, reasons), (product, change)
        assert decided[i]["rule_pack_version"] == packs.current_packs()[product].version


def test_decision_ids_are_repeatable(spark, as_of):
    rows = vectors(spark, [{"product": p} for p in ("bnpl", "personal_finance")])
    ids = lambda run: {r[0] for r in decisions.decide(rows, as_of, run).select("decision_id").collect()}
    assert ids("a") == ids("a") and len(ids("a")) == 2 and not ids("a") & ids("b")
    assert all(i.startswith("dcn_") and len(i) == 30 for i in ids("a"))


def test_older_versions_are_replayed_with_their_own_rules(spark):
    strict = packs.RulePack("bnpl", "bnpl_v0", lambda v: [packs.decline_if(v("kyc_age_days") < 9999, "OLD_RULE")])
    both = (strict, *packs.PACKS)
    rows = vectors(spark, [{"product": "bnpl"}])
    answer = lambda version: packs.evaluate_version(F.col("product"), F.lit(version), F.col, both)["outcome"]
    got = rows.select(answer("bnpl_v0").alias("old"), answer("bnpl_v1.1.0").alias("new"), answer("gone").alias("unknown")).head()
    assert tuple(got) == ("DECLINE", "APPROVE", "APPROVE")


def test_packs_stay_inside_the_jvm(spark, as_of):
    plan = decisions.decide(vectors(spark, [{}]), as_of, "run")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_vector_of_a_customer_without_any_source(spark, as_of):
    silver = {"profile": profiles(spark), "aecb": bureau(spark, []), "fraud": fraud(spark, []), "aml": aml(spark, [])}
    rows = assembly.assemble(silver, as_of)
    assert rows.count() == 6 and list(rows.columns) == list(assembly.VECTOR_COLUMNS)
    row = one(rows.where((F.col("emirates_id") == KNOWN_EID) & (F.col("product") == "bnpl")))
    assert row["credit_score"] is None and row["num_bounced_cheques"] == 0 and row["total_claim_amount"] == 0.0
    assert row["payment_order_flag"] is False and row["fraud_reason_codes"] == [] and row["aml_matched_lists"] == []
    assert (row["aecb_available"], row["fraud_available"], row["aml_available"]) == (False, False, False)
    assert row["aml_stale_seconds"] is None and row["kyc_age_days"] == 474


def test_vector_takes_the_last_record_of_each_source(spark, as_of):
    received = as_of - timedelta(seconds=90)
    silver = {
        "profile": profiles(spark),
        "aecb": bureau(spark, [{"emirates_id": KNOWN_EID, "credit_score": 1}, {"emirates_id": KNOWN_EID, "credit_score": 2}]),
        "fraud": fraud(spark, [{"emirates_id": KNOWN_EID, "score": 5, "raw_path": "z"}, {"emirates_id": KNOWN_EID, "score": 6, "raw_path": "a"}]),
        "aml": aml(spark, [{"emirates_id": KNOWN_EID, "received_at": received, "status": "REVIEW", "matched_lists": ["PEP"]}]),
    }
    row = one(assembly.assemble(silver, as_of, products=("bnpl",)).where(F.col("emirates_id") == KNOWN_EID))
    assert (row["credit_score"], row["fraud_score"], row["aml_stale_seconds"]) == (2, 5, 90)
    assert row["aml_matched_lists"] == ["PEP"] and row["aml_status"] == "REVIEW"


def test_first_and_last_per_key_keep_one_row_per_map_task(spark):
    rows = fraud(spark, [{"emirates_id": k, "score": i} for i, k in enumerate(["a", "b", "a", None, "", "b", "a"])])
    last = {r["emirates_id"]: r["score"] for r in keyed.latest_per_key(rows, "emirates_id").collect()}
    first = {r["emirates_id"]: r["score"] for r in keyed.first_per_key(rows, "emirates_id").collect()}
    assert last == {"a": 6, "b": 5} and first == {"a": 0, "b": 1}
    plan = keyed.latest_per_key(rows, "emirates_id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


@pytest.fixture(scope="module")
def facts(spark):
    rows = [
        ("bnpl", "APPROVE", ["ALL_CHECKS_PASSED"], 700), ("bnpl", "DECLINE", ["AML_HIT", "FRAUD_FAIL"], 640),
        ("bnpl", "REFER", ["AML_PENDING"], None), ("personal_finance", "DECLINE", ["AML_HIT"], 649),
    ]
    stamp = datetime(2026, 4, 20, tzinfo=timezone.utc)
    return spark.createDataFrame(
        [(f"d{i}", f"e{i}", p, stamp, o, r, s) for i, (p, o, r, s) in enumerate(rows)],
        "decision_id string, emirates_id string, product string, decision_ts timestamp, outcome string,"
        " reason_codes array<string>, credit_score int",
    )


def test_reports(facts):
    rates = {r["product"]: (r["decisions"], r["approved"], r["approval_rate"]) for r in reports.approval_rate(facts).collect()}
    assert rates == {"bnpl": (3, 1, 33.3), "personal_finance": (1, 0, 0.0)}
    pivot = {r["product"]: (r["APPROVE"], r["DECLINE"], r["REFER"]) for r in reports.outcome_by_product(facts).collect()}
    assert pivot == {"bnpl": (1, 1, 1), "personal_finance": (0, 1, 0)}
    assert [tuple(r) for r in reports.top_decline_reasons(facts, 1).collect()] == [("AML_HIT", 2)]
    kpis = one(reports.portfolio_kpis(facts))
    assert (kpis["decisions"], kpis["decline"], kpis["decline_share"]) == (4, 2, 0.5)
    spread = {r["score_from"]: r["DECLINE"] for r in reports.score_distribution(facts).collect()}
    assert spread == {700: 0, 600: 2}
    assert [r["decision_id"] for r in reports.decision_lookup(facts, product="bnpl", limit=2).collect()] == ["d0", "d1"]
    assert one(reports.decision_lookup(facts, decision_id="d3"))["product"] == "personal_finance"


def test_reports_on_no_decisions(facts):
    none = facts.where("false")
    kpis = one(reports.portfolio_kpis(none))
    assert kpis["decisions"] == 0 and kpis["approve_share"] is None
    assert reports.top_decline_reasons(none).count() == 0


def test_dimensions(spark):
    assert decisions.dim_product(spark).count() == 3
    assert decisions.dim_customer(profiles(spark)).columns == ["emirates_id", "full_name", "emirate", "kyc_verified_at"]

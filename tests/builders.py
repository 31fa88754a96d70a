"""Small tables for the tests, one row per dict; absent columns are NULL."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lendspark import schemas
from lendspark.operators.vectors import VECTOR_COLUMNS

KNOWN_EID = "784-1979-2468013-5"


def frame(spark: SparkSession, ddl: str, rows: list[dict]) -> DataFrame:
    names = StructType.fromDDL(ddl).fieldNames()
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], ddl)


def _placed(rows: list[dict], folder: str) -> list[dict]:
    return [{"raw_path": folder, "position": (0, i), **r} for i, r in enumerate(rows)]


def profiles(spark, rows: list[dict] | None = None) -> DataFrame:
    if rows is None:
        rows = [
            {"internal_uuid": "u1", "emirates_id": KNOWN_EID, "full_name": "Bassam Al Zaabi", "dob": "1979-11-03",
             "phone": "+971552468013", "email": "bassam.z@post.example", "emirate": "Fujairah"},
            {"internal_uuid": "u2", "emirates_id": "784-1995-1357924-8", "full_name": "Salma Qureshi",
             "dob": "1995-08-30", "phone": "+971561357924", "email": "salma.q@post.example", "emirate": "Ajman"},
        ]
    base = {"is_new_user": False, "had_overdue_before": False, "kyc_verified_at": datetime(2025, 1, 1, tzinfo=timezone.utc)}
    return frame(spark, schemas.SILVER_PROFILE, _placed([base | r for r in rows], "profile"))


def bureau(spark, rows: list[dict]) -> DataFrame:
    base = {"report_id": "r", "report_date": "2026-04-18", "full_name": "", "dob": "", "payment_order_flag": False,
            "num_bounced_cheques": 0, "total_bounced_cheques_amount": 0.0, "num_court_cases": 0,
            "num_open_court_cases": 0, "total_claim_amount": 0.0}
    return frame(spark, schemas.SILVER_BUREAU, _placed([base | r for r in rows], "aecb"))


def fraud(spark, rows: list[dict]) -> DataFrame:
    base = {"provider_ref": "f", "decision": "PASS", "score": 100, "reason_codes": []}
    return frame(spark, schemas.SILVER_FRAUD, _placed([base | r for r in rows], "fraud"))


def aml(spark, rows: list[dict]) -> DataFrame:
    base = {"callback_id": "a", "status": "CLEAR", "matched_lists": [], "received_at": datetime(2026, 4, 20, tzinfo=timezone.utc)}
    return frame(spark, schemas.SILVER_AML, _placed([base | r for r in rows], "aml"))


# An applicant nobody objects to; what is not named here is filled by the type of its column.
_BY_TYPE = {"boolean": False, "int": 0, "bigint": 45, "double": 0.0, "array<string>": []}
CLEAN_VECTOR = {
    "emirates_id": "784-1983-0000042-6", "product": "personal_finance", "as_of_ts": datetime(2026, 4, 20, tzinfo=timezone.utc),
    "full_name": "Huda Mirza", "dob": "1983-02-17", "phone": "+971559990042", "email": "huda@post.example", "emirate": "Sharjah",
    "kyc_age_days": 410, "credit_score": 745, "score_range": "B", "gross_annual_income": 144000.0, "fraud_score": 85,
    "fraud_decision": "PASS", "aml_status": "CLEAR",
    "aecb_available": True, "fraud_available": True, "aml_available": True,
}


def vectors(spark, rows: list[dict]) -> DataFrame:
    fields = StructType.fromDDL(schemas.VECTOR).fields
    filled = {f.name: _BY_TYPE.get(f.dataType.simpleString()) for f in fields} | CLEAN_VECTOR
    return frame(spark, schemas.VECTOR, [filled | r for r in rows]).select(*VECTOR_COLUMNS)


def customer(i: int) -> str:
    return f"784-1990-{i:07d}-{i % 10}"


def one(df: DataFrame) -> dict:
    rows = df.collect()
    assert len(rows) == 1, rows
    return rows[0].asDict()


def column(df: DataFrame, name: str) -> list:
    return [r[name] for r in df.select(F.col(name)).collect()]

from __future__ import annotations

import json
import sqlite3

import pytest
from builders import column, one
from pyspark.sql import functions as F

from lendspark import schemas
from lendspark.operators import bronze, silver
from lendspark.sources.files import scan_json_records
from lendspark.sources.profile_db import read_profile_tables

SOAP = (
    '<?xml version="1.0" encoding="utf-8"?><s:Envelope xmlns:s="http://schemas.xmlsoap.org/soap/envelope/"'
    ' xmlns:a="urn:crif-message:2006-08-23" xmlns:b="urn:crif-messagegateway:2006-08-23" xmlns:n="urn:NAE">'
    "<s:Header>{header}</s:Header><s:Body>{body}</s:Body></s:Envelope>"
)
REPORT = """
<n:ResponseId>resp-1</n:ResponseId>
<n:NewApplication><n:CBContractId>A1</n:CBContractId></n:NewApplication>
<n:EnquiredSubject><n:Individual>
  <n:NameEN><n:FirstName>SAMIRA</n:FirstName><n:LastName>KHOURY</n:LastName></n:NameEN>
  <n:DOB>09041991</n:DOB><n:EmiratesId> 784-1991-5550123-4 </n:EmiratesId></n:Individual></n:EnquiredSubject>
<n:Response>
  <n:MatchedSubject><n:CBSubjectId>912</n:CBSubjectId><n:Individual>
    <n:FullNameEN>SAMIRA LINA KHOURY</n:FullNameEN><n:Nationality>LB</n:Nationality></n:Individual></n:MatchedSubject>
  <n:EmploymentHistory><n:UpdateInfo><n:DateOfUpdate>01012020</n:DateOfUpdate></n:UpdateInfo>
    <n:EmploymentInfo><n:GrossAnnualIncome>1000</n:GrossAnnualIncome><n:ActualFlag>1</n:ActualFlag></n:EmploymentInfo></n:EmploymentHistory>
  <n:EmploymentHistory><n:UpdateInfo><n:DateOfUpdate>15062023</n:DateOfUpdate></n:UpdateInfo>
    <n:EmploymentInfo><n:GrossAnnualIncome>81000.5</n:GrossAnnualIncome><n:ActualFlag>1</n:ActualFlag></n:EmploymentInfo></n:EmploymentHistory>
  <n:EmploymentHistory><n:UpdateInfo><n:DateOfUpdate>15062023</n:DateOfUpdate></n:UpdateInfo>
    <n:EmploymentInfo><n:GrossAnnualIncome>7</n:GrossAnnualIncome><n:ActualFlag>1</n:ActualFlag></n:EmploymentInfo></n:EmploymentHistory>
  <n:EmploymentHistory><n:UpdateInfo><n:DateOfUpdate>01012024</n:DateOfUpdate></n:UpdateInfo>
    <n:EmploymentInfo><n:GrossAnnualIncome>9</n:GrossAnnualIncome><n:ActualFlag>0</n:ActualFlag></n:EmploymentInfo></n:EmploymentHistory>
  <n:PaymentOrder><n:Severity>1</n:Severity><n:Amount>210.5</n:Amount></n:PaymentOrder>
  <n:PaymentOrder><n:Severity>1</n:Severity><n:Amount>bad</n:Amount></n:PaymentOrder>
  <n:PaymentOrder><n:Severity>2</n:Severity><n:Amount>9</n:Amount></n:PaymentOrder>
  <n:Cases><n:CaseStatusCode>55</n:CaseStatusCode><n:InitialTotalClaimAmount>10</n:InitialTotalClaimAmount></n:Cases>
  <n:Cases><n:CaseStatusCode>90</n:CaseStatusCode><n:InitialTotalClaimAmount>20</n:InitialTotalClaimAmount></n:Cases>
  <n:Cases><n:InitialTotalClaimAmount>5</n:InitialTotalClaimAmount></n:Cases>
  <n:Score><n:Data><n:Index>300</n:Index><n:Range>A</n:Range></n:Data><n:PaymentOrderFlag>y</n:PaymentOrderFlag></n:Score>
</n:Response>"""
HEADER = '<a:MessageResponse MTs="2026-04-18T12:21:37.6+00:00"/>'


def document(report: str, header: str = HEADER) -> str:
    body = f"<b:MGResponse><b:MGResponse><n:NAE_RES>{report}</n:NAE_RES></b:MGResponse></b:MGResponse>"
    return SOAP.format(header=header, body=body)


def landed(spark, source, as_of, *texts):
    files = spark.createDataFrame([(f"/in/{i}.x", t.encode()) for i, t in enumerate(texts)], "path string, content binary")
    return bronze.envelopes(files, source, "run", as_of)


def parse(spark, as_of, *texts):
    return silver.parse_bureau(landed(spark, "aecb", as_of, *texts), as_of)


def test_whole_report(spark, as_of):
    row = one(parse(spark, as_of, document(REPORT)).rows)
    expected = {
        "report_id": "A1", "cb_subject_id": "912", "report_date": "2026-04-18", "emirates_id": "784-1991-5550123-4",
        "full_name": "SAMIRA LINA KHOURY", "dob": "1991-04-09", "nationality": "LB", "credit_score": 300,
        "score_range": "A", "payment_order_flag": True, "num_bounced_cheques": 2,
        "total_bounced_cheques_amount": 210.5, "num_court_cases": 3, "num_open_court_cases": 2,
        "total_claim_amount": 35.0, "gross_annual_income": 81000.5, "ingest_run_id": "run",
    }
    assert {k: row[k] for k in expected} == expected


def test_sparse_report(spark, as_of):
    report = (
        "<n:ResponseId>resp-2</n:ResponseId><n:EnquiredSubject><n:Individual><n:NameEN><n:FirstName>A</n:FirstName>"
        "<n:LastName>B</n:LastName></n:NameEN><n:DOB>31021988</n:DOB></n:Individual></n:EnquiredSubject>"
    )
    row = one(parse(spark, as_of, document(report, "")).rows)
    assert row["report_id"] == "resp-2" and row["full_name"] == "A B" and row["dob"] == "31021988"
    assert row["report_date"] == "2026-04-20" and row["emirates_id"] is None and row["credit_score"] is None
    assert row["payment_order_flag"] is False and row["num_court_cases"] == 0 and row["gross_annual_income"] is None


def test_bad_documents_are_set_aside(spark, as_of):
    whole = document(REPORT)
    parsed = parse(spark, as_of, whole, whole[:400], SOAP.format(header="", body=""))
    assert parsed.rows.count() == 1
    assert sorted(column(parsed.rejects, "reason")) == ["malformed XML", "no report body"]


def test_documents_are_parsed_once(spark, as_of):
    plan = parse(spark, as_of, document(REPORT)).rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_xml") == 1


FRAUD_ITEM = {
    "provider_ref": "f1", "emirates_id": " 784-1990-abc ", "phone": "+1", "email": "A@B.ae", "score": 7,
    "decision": "PASS", "reason_codes": ["X"], "model_version": "v", "scored_at": "2026-04-18T12:00:00+04:00",
}


def fraud(spark, as_of, items, strict=False):
    rows = landed(spark, "fraud", as_of, items if isinstance(items, str) else json.dumps(items))
    return silver.parse_fraud(silver.json_items(rows, schemas.FRAUD_ITEM), strict)


def test_fraud_items(spark, as_of):
    plain = dict(FRAUD_ITEM)
    del plain["reason_codes"]
    rows = fraud(spark, as_of, [FRAUD_ITEM, plain | {"provider_ref": "f2", "score": "12"}]).rows.orderBy("position")
    first, second = rows.collect()
    assert first["emirates_id"] == "784-1990-ABC" and first["email"] == "a@b.ae" and first["score"] == 7
    assert str(rows.select(F.date_format("scored_at", "HH:mm")).head()[0]) == "08:00"
    assert second["reason_codes"] == [] and second["score"] == 12 and second["position"]["row"] == 1


@pytest.mark.parametrize(
    ("change", "reason"),
    [({"score": "high"}, "score missing"), ({"score": 1.5}, "score missing"), ({"decision": "MAYBE"}, "decision not allowed"),
     ({"decision": None}, "decision not allowed"), ({"scored_at": "soon"}, "scored_at missing"), ({"phone": None}, "phone missing")],
)
def test_bad_fraud_items_are_rejected(spark, as_of, change, reason):
    parsed = fraud(spark, as_of, [FRAUD_ITEM, FRAUD_ITEM | change])
    assert parsed.rows.count() == 1
    rejected = one(parsed.rejects)
    assert rejected["reason"] == reason and rejected["source"] == "fraud" and '"provider_ref":"f1"' in rejected["raw"]


def test_strict_parsing_fails_the_job(spark, as_of):
    with pytest.raises(Exception, match="decision not allowed"):
        fraud(spark, as_of, [FRAUD_ITEM | {"decision": "MAYBE"}], strict=True).rows.collect()


def test_malformed_json_is_rejected_and_an_empty_array_is_not(spark, as_of):
    assert fraud(spark, as_of, "{not json").rejects.count() == 1
    empty = fraud(spark, as_of, "[]")
    assert empty.rows.count() == 0 and empty.rejects.count() == 0


def test_json_files_are_read_as_records(spark, tmp_path):
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "a.json").write_text("\n".join(json.dumps(FRAUD_ITEM | {"provider_ref": f"f{i}"}) for i in range(5)))
    (tmp_path / "array").mkdir()
    (tmp_path / "array" / "a.json").write_text(json.dumps([FRAUD_ITEM, FRAUD_ITEM]))
    lines = scan_json_records(spark, str(tmp_path / "lines"), schemas.FRAUD_ITEM)
    assert [r["item"]["provider_ref"] for r in lines.orderBy("raw_path", "position").collect()] == [f"f{i}" for i in range(5)]
    items = scan_json_records(spark, str(tmp_path / "array"), schemas.FRAUD_ITEM, lines=False)
    parsed = silver.parse_fraud(items.withColumn("ingest_run_id", F.lit("r")))
    assert parsed.rows.count() == 2


def profile_db(path, applications, instalments):
    connection = sqlite3.connect(path)
    for table, ddl in (("users", schemas.USERS), ("applications", schemas.APPLICATIONS), ("instalments", schemas.INSTALMENTS)):
        connection.execute(f"CREATE TABLE {table} ({ddl.replace(' string', ' TEXT').replace(' double', ' REAL')})")
    users = [
        (f"u{i}", f"784-1990-000000{i}-0", "A", "B", "A B", "1990-01-01", "+9715", "A@B", "Dubai", "2025-01-01T00:00:00+00:00")
        for i in range(1, 6)
    ]
    connection.executemany(f"INSERT INTO users VALUES ({','.join('?' * 10)})", users)
    connection.executemany("INSERT INTO applications VALUES (?, ?, 'bnpl', 1000.0, 'APPROVE', '2024-01-01')", applications)
    connection.executemany("INSERT INTO instalments VALUES (?, ?, '2024-02-01', 500.0, NULL, ?, 0)", instalments)
    connection.commit()
    connection.close()


def test_behavioural_features_from_a_database_file(spark, tmp_path):
    path = str(tmp_path / "profile.db")
    applications = [("a2", "u2"), ("a3", "u3"), ("a4", "u4"), ("a5", "u5"), ("a6", "u5")]
    instalments = [
        ("i1", "a3", "PAID_ON_TIME"), ("i2", "a3", "OVERDUE"), ("i3", "a4", "PAID_LATE"), ("i4", "a5", "PAID_ON_TIME"),
        ("i5", "a6", "UPCOMING"), ("i6", "nowhere", "OVERDUE"),
    ]
    profile_db(path, applications, instalments)
    tables = read_profile_tables(spark, path)
    parsed = silver.parse_profile(tables["users"], tables["applications"], tables["instalments"], "run")
    got = {r["internal_uuid"]: (r["is_new_user"], r["had_overdue_before"]) for r in parsed.rows.collect()}
    assert got == {"u1": (True, False), "u2": (False, False), "u3": (False, True), "u4": (False, True), "u5": (False, False)}
    assert set(column(parsed.rows, "email")) == {"a@b"} and parsed.rejects.count() == 0


def test_database_tables_are_read_in_row_ranges(spark, tmp_path):
    path = str(tmp_path / "profile.db")
    profile_db(path, [(f"a{i}", "u1") for i in range(25)], [])
    read_profile_tables(spark, path)
    table = spark.read.format("sqlite_table").schema(schemas.APPLICATIONS).options(path=path, table="applications", rowsPerPartition=10).load()
    assert table.count() == 25 and table.rdd.getNumPartitions() == 3
    assert read_profile_tables(spark, path)["instalments"].count() == 0


def test_profile_without_an_id_is_rejected(spark):
    users = spark.createDataFrame([("u1", " ", "A", "B", "A B", "1990-01-01", "+1", "e", "Dubai", "2025-01-01")], schemas.USERS)
    none = spark.createDataFrame([], schemas.APPLICATIONS), spark.createDataFrame([], schemas.INSTALMENTS)
    parsed = silver.parse_profile(users, *none, "run")
    assert parsed.rows.count() == 0 and one(parsed.rejects)["reason"] == "emirates_id missing"

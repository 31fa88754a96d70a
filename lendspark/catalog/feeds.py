"""The four feeds derived from the given tables, as SQL that reads the same in Spark and DuckDB.

Modular rules on the customer key put every messy case in: missing and malformed IDs, duplicates,
strangers, misspelt names, ambiguous birth dates, stale reports. A neighbour places the orders of every
seventh customer, who is new for that.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendspark.config import AML, BUREAU, FRAUD, PROFILE
from lendspark.operators import bronze, silver
from lendspark.session import scratch_path
from lendspark.sources.files import write_each
from lendspark.sources.json_arrays import scan_array_elements

AS_OF = datetime(2024, 2, 1, tzinfo=timezone.utc)
RUN_ID = "run_check"
TABLES = ("customer", "nation", "orders", "lineitem", "supplier")

# name -> query; a query may use the ones before it and the given tables in braces
FEEDS = {
    "named": """
SELECT c_custkey AS k, c_nationkey,
       split_part('Tarek,Nadia,Jamil,Samira,Bilal,Huda,Karim,Leena,Faris,Dalia,Bassam,Rania,Idris,Salma,Walid,Amal,Nabil,Yasmin,Zahir,Lubna',
                  ',', CAST(c_custkey % 20 + 1 AS INT)) AS first_name,
       split_part('Haddad,Al Zaabi,Qureshi,Darwish,Menon,Al Ketbi,Farouk,Mirza,Khoury,Al Suwaidi,Iyer,Saleh,Rahman,Nasser,Al Ameri',
                  ',', CAST(floor(c_custkey / 20) % 15 + 1 AS INT)) AS last_name
FROM {customer}""",
    "users": """
SELECT k, 'u' || k AS internal_uuid,
       '784-' || (1970 + k % 36) || '-' || (1000000 + k) || '-' || (k % 10) AS emirates_id,
       first_name, last_name, first_name || ' ' || last_name AS full_name,
       CAST(DATE '1960-01-01' + CAST(CASE WHEN k % 10 = 0 THEN k % 300 ELSE (k * 37) % 499 END AS INT) AS STRING) AS dob,
       '+9715' || lpad(CAST(k AS STRING), 8, '0') AS phone,
       'c' || k || '@example.ae' AS email,
       n_name AS emirate,
       TIMESTAMP '2024-02-01 00:00:00' - INTERVAL '1' DAY * CAST((k * 13) % 700 AS INT) AS kyc_verified_at
FROM named JOIN {nation} ON c_nationkey = n_nationkey""",
    "applications": """
SELECT 'a' || o_orderkey AS application_id,
       'u' || CASE WHEN o_custkey % 7 = 0 THEN o_custkey + 1 ELSE o_custkey END AS internal_uuid,
       CASE o_orderkey % 3 WHEN 0 THEN 'personal_finance' WHEN 1 THEN 'bnpl' ELSE 'credit_card_alt' END AS product,
       o_totalprice AS amount,
       CASE o_orderstatus WHEN 'F' THEN 'APPROVE' WHEN 'P' THEN 'DECLINE' ELSE 'REFER' END AS decision,
       o_orderdate AS applied_at
FROM {orders}""",
    "instalments": """
SELECT 'a' || l_orderkey AS application_id, l_linenumber AS line_no, l_shipdate AS due_date, l_extendedprice AS amount,
       CASE WHEN l_returnflag = 'R' AND l_quantity >= 45
            THEN CASE WHEN l_linestatus = 'O' THEN 'OVERDUE' ELSE 'PAID_LATE' END
            ELSE 'PAID_ON_TIME' END AS status
FROM {lineitem}""",
    "fraud_raw": """
SELECT k, 'frd_' || k AS provider_ref, 0 AS ordinal,
       CASE WHEN k % 25 = 4 THEN NULL WHEN k % 50 = 9 THEN 'BAD-' || k ELSE emirates_id END AS emirates_id,
       CASE WHEN k % 10 = 3 THEN '+9715' || lpad(CAST(k + 50000000 AS STRING), 8, '0') ELSE phone END AS phone,
       CASE WHEN k % 20 = 5 THEN 'x' || email ELSE email END AS email,
       CAST((k * 104729) % 1001 AS INT) AS score,
       CASE WHEN (k * 104729) % 1001 >= 800 THEN 'FAIL' WHEN (k * 104729) % 1001 > 500 THEN 'REVIEW' ELSE 'PASS' END AS decision
FROM users
UNION ALL
SELECT k, 'frd_dup_' || k, 1, emirates_id, phone, email, CAST(100 AS INT), 'PASS' FROM users WHERE k % 40 = 11
UNION ALL
SELECT s_suppkey, 'frd_str_' || s_suppkey, 0, '784-2099-' || (9000000 + s_suppkey) || '-0', '+97199',
       'stranger@example.ae', CAST(10 AS INT), 'PASS' FROM {supplier}""",
    "fraud_feed": """
SELECT k, ordinal, provider_ref, emirates_id, phone, email, score, decision,
       CASE decision WHEN 'FAIL' THEN 'VELOCITY,SYNTHETIC_ID_RISK' WHEN 'REVIEW' THEN 'EMAIL_AGE' ELSE '' END AS codes
FROM fraud_raw""",
    "aml_feed": """
SELECT k, 'aml_' || k AS callback_id,
       CASE WHEN k % 12 IN (6, 10) THEN NULL ELSE emirates_id END AS emirates_id,
       CASE WHEN k % 20 = 10 THEN 'Bsasam ' || last_name ELSE full_name END AS full_name,
       dob,
       CASE WHEN k % 50 = 1 THEN 'HIT' WHEN k % 20 = 2 THEN 'REVIEW' ELSE 'CLEAR' END AS status,
       CASE WHEN k % 50 = 1 THEN 'UN_SANCTIONS,PEP' WHEN k % 20 = 2 THEN 'PEP' ELSE '' END AS lists,
       TIMESTAMP '2024-02-01 00:00:00' - INTERVAL '1' SECOND * CAST(k % 86400 AS INT) AS received_at
FROM users WHERE k % 33 <> 0""",
    "bureau_raw": """
SELECT k, 'A' || (10000000 + k) AS report_id,
       CASE WHEN k % 20 = 1 THEN NULL ELSE emirates_id END AS emirates_id,
       upper(full_name) AS full_name, dob,
       CAST(300 + (k * 7919) % 601 AS INT) AS credit_score,
       CAST(CASE WHEN k % 7 = 0 THEN 1 + k % 5 ELSE 0 END AS INT) AS num_bounced_cheques,
       CAST(CASE WHEN k % 14 = 0 THEN 1 + k % 3 ELSE 0 END AS INT) AS num_court_cases,
       CAST(CASE WHEN k % 14 = 0 AND k % 4 <> 0 THEN 1 + k % 3 ELSE 0 END AS INT) AS num_open_court_cases,
       CAST(40000 + (k * 31) % 200000 AS DOUBLE) AS gross_annual_income,
       CAST(k % 28 AS INT) AS age_days_clean, CAST(k % 40 AS INT) AS age_days_dirty
FROM users WHERE k % 40 <> 13""",
    "bureau_feed": """
SELECT k, report_id, 'S' || k AS cb_subject_id,
       CAST(DATE '2024-02-01' - age_days_clean AS STRING) AS report_date,
       CAST(DATE '2024-02-01' - age_days_dirty AS STRING) AS report_date_dirty,
       emirates_id, full_name, dob, 'AE' AS nationality, credit_score,
       CASE WHEN credit_score >= 700 THEN 'A' WHEN credit_score >= 500 THEN 'C' ELSE 'F' END AS score_range,
       num_bounced_cheques > 0 AS payment_order_flag,
       num_bounced_cheques, CAST(num_bounced_cheques * 1500 AS DOUBLE) AS total_bounced_cheques_amount,
       num_court_cases, num_open_court_cases,
       CAST(num_court_cases * 2500 AS DOUBLE) AS total_claim_amount, gross_annual_income
FROM bureau_raw""",
    # One SOAP document per report. A minor payment order and a newer but not actual employment must
    # not count; every 97th document is cut off and every 97th has an empty body.
    # The rows are spread over the cores first: a document is a hundred times as large as its row.
    "bureau_whole": """
SELECT /*+ REPARTITION({cores}) */ k, report_id,
       '<?xml version="1.0" encoding="utf-8"?><soap:Envelope xmlns:soap="http://schemas.xmlsoap.org/soap/envelope/"'
       || ' xmlns:m="urn:crif-message:2006-08-23" xmlns:g="urn:crif-messagegateway:2006-08-23" xmlns:n="urn:NAE">'
       || '<soap:Header><m:MessageResponse MTs="' || report_date || 'T08:30:00"/></soap:Header><soap:Body>' AS head,
       '<g:MGResponse><g:MGResponse><n:NAE_RES><n:ResponseId>r' || k || '</n:ResponseId>'
       || CASE WHEN k % 9 = 0 THEN '' ELSE '<n:NewApplication><n:CBContractId>' || report_id || '</n:CBContractId></n:NewApplication>' END
       || '<n:EnquiredSubject><n:Individual><n:NameEN><n:FirstName>' || full_name || '</n:FirstName><n:LastName></n:LastName></n:NameEN>'
       || '<n:DOB>' || substr(dob, 9, 2) || substr(dob, 6, 2) || substr(dob, 1, 4) || '</n:DOB>'
       || CASE WHEN k % 3 = 0 THEN '<n:Nationality>' || nationality || '</n:Nationality>' ELSE '' END
       || CASE WHEN k % 2 = 0 THEN coalesce('<n:EmiratesId> ' || emirates_id || ' </n:EmiratesId>', '') ELSE '' END
       || '</n:Individual></n:EnquiredSubject><n:Response><n:MatchedSubject><n:CBSubjectId>' || cb_subject_id
       || '</n:CBSubjectId><n:Individual>'
       || CASE WHEN k % 5 = 0 THEN '' ELSE '<n:FullNameEN>' || full_name || '</n:FullNameEN>' END
       || '<n:Nationality>' || nationality || '</n:Nationality>'
       || coalesce('<n:EmiratesId>' || emirates_id || '</n:EmiratesId>', '') || '</n:Individual></n:MatchedSubject>'
       || '<n:EmploymentHistory><n:UpdateInfo><n:DateOfUpdate>01012024</n:DateOfUpdate></n:UpdateInfo><n:EmploymentInfo>'
       || '<n:GrossAnnualIncome>999999</n:GrossAnnualIncome><n:ActualFlag>0</n:ActualFlag></n:EmploymentInfo></n:EmploymentHistory>'
       || '<n:EmploymentHistory><n:UpdateInfo><n:DateOfUpdate>31122022</n:DateOfUpdate></n:UpdateInfo><n:EmploymentInfo>'
       || '<n:GrossAnnualIncome>1</n:GrossAnnualIncome><n:ActualFlag>1</n:ActualFlag></n:EmploymentInfo></n:EmploymentHistory>'
       || '<n:EmploymentHistory><n:UpdateInfo><n:DateOfUpdate>01012020</n:DateOfUpdate></n:UpdateInfo>'
       || '<n:UpdateInfo><n:DateOfUpdate>15062023</n:DateOfUpdate></n:UpdateInfo><n:EmploymentInfo><n:GrossAnnualIncome>'
       || CAST(CAST(gross_annual_income AS INT) AS STRING)
       || '</n:GrossAnnualIncome><n:ActualFlag>1</n:ActualFlag></n:EmploymentInfo></n:EmploymentHistory>'
       || repeat('<n:PaymentOrder><n:Severity>1</n:Severity><n:Amount>1500.0</n:Amount></n:PaymentOrder>', num_bounced_cheques)
       || CASE WHEN num_bounced_cheques > 0 THEN '<n:PaymentOrder><n:Severity>2</n:Severity><n:Amount>7</n:Amount></n:PaymentOrder>' ELSE '' END
       || repeat('<n:Cases><n:CaseStatusCode>55</n:CaseStatusCode><n:InitialTotalClaimAmount>2500</n:InitialTotalClaimAmount></n:Cases>', num_open_court_cases)
       || repeat('<n:Cases><n:CaseStatusCode>90</n:CaseStatusCode><n:InitialTotalClaimAmount>2500</n:InitialTotalClaimAmount></n:Cases>', num_court_cases - num_open_court_cases)
       || '<n:Score><n:Data><n:Index>' || credit_score || '</n:Index><n:Range>' || score_range || '</n:Range></n:Data><n:PaymentOrderFlag>'
       || CASE WHEN payment_order_flag THEN 'y' ELSE 'N' END
       || '</n:PaymentOrderFlag></n:Score></n:Response></n:NAE_RES></g:MGResponse></g:MGResponse>' AS body
FROM bureau_feed""",
    "bureau_documents": """
SELECT k, report_id || '.xml' AS name,
       CASE WHEN k % 97 = 5 THEN head || substr(body, 1, 200)
            WHEN k % 97 = 6 THEN head || '</soap:Body></soap:Envelope>'
            ELSE head || body || '</soap:Body></soap:Envelope>' END AS text
FROM bureau_whole
UNION ALL
SELECT k, 'dup_' || report_id || '.xml', head || body || '</soap:Body></soap:Envelope>'
FROM bureau_whole WHERE k % 97 = 7""",
    # JSON items as text; some of the dirty ones break a type, an enum or a required field.
    "fraud_items": """
SELECT k, '{{"provider_ref":"' || provider_ref || '","emirates_id":' || coalesce('" ' || lower(emirates_id) || '"', 'null')
       || ',"phone":"' || phone || '","email":"' || upper(email) || '","score":' || score || ',"decision":"' || decision
       || '","reason_codes":[' || CASE WHEN codes = '' THEN '' ELSE '"' || replace(codes, ',', '","') || '"' END
       || '],"model_version":"v3.2.1","scored_at":"2024-01-31T12:00:00+00:00"}}' AS item,
       '{{"provider_ref":"' || provider_ref || '","emirates_id":' || coalesce('"' || emirates_id || '"', 'null')
       || ',"phone":"' || phone || '","email":"' || email || '","score":' || CASE WHEN k % 101 = 1 THEN '"high"' ELSE CAST(score AS STRING) END
       || ',"decision":"' || CASE WHEN k % 101 IN (2, 3) THEN 'MAYBE' ELSE decision END || '"'
       || CASE WHEN k % 101 IN (3, 4) THEN '' ELSE ',"model_version":"v3.2.1"' END
       || ',"scored_at":"' || CASE WHEN k % 101 = 5 THEN 'soon' ELSE '2024-01-31T12:00:00+00:00' END || '"}}' AS dirty_item
FROM fraud_feed""",
    "aml_items": """
SELECT k, '{{"callback_id":"' || callback_id || '","emirates_id":' || coalesce('"' || emirates_id || '"', 'null')
       || ',"full_name":"' || full_name || '","dob":"' || dob || '","status":"' || status
       || '","matched_lists":[' || CASE WHEN lists = '' THEN '' ELSE '"' || replace(lists, ',', '","') || '"' END
       || '],"received_at":"' || substr(CAST(received_at AS STRING), 1, 10) || 'T' || substr(CAST(received_at AS STRING), 12, 8) || '+00:00"}}' AS item
FROM aml_feed""",
}

_JSON_DOCUMENT_KEYS = 100  # customers per JSON document


_TRICKY = '{"trace":{"note":"} ], [{ \\" , \\\\","path":[[1,{"a":{}}],"]"]},'


def _in_brackets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines of a task as one JSON array, as they come."""
    started = False
    for batch in batches:
        lines = [("," if started or i else "[") + line for i, line in enumerate(batch.column(0).to_pylist())]
        started = started or bool(lines)
        yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["value"])
    yield pa.RecordBatch.from_arrays([pa.array(["]" if started else "[]"])], names=["value"])


class Feeds:
    """The feeds of one scale directory, and the silver tables they stand for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        tag = zlib.crc32(f"{spark.sparkContext.applicationId}{sf_dir}".encode())
        views = {t: f"given_{t}_{tag}" for t in TABLES}
        self.names = views | {"cores": str(spark.sparkContext.defaultParallelism)}
        for table, view in views.items():
            if not spark.catalog.tableExists(view):
                spark.read.parquet(f"{sf_dir}/{table}.parquet").createOrReplaceTempView(view)

    def query(self, sql: str) -> DataFrame:
        """A query over the feeds, with only the feeds it needs written out before it."""
        needed: list[str] = []
        text = sql
        for name in reversed(FEEDS):
            if re.search(rf"\b{name}\b", text):
                needed.insert(0, name)
                text += FEEDS[name]
        ctes = ", ".join(f"{name} AS ({FEEDS[name]})" for name in needed)
        return self.spark.sql(f"WITH {ctes} {sql}".format(**self.names))

    def feed(self, name: str) -> DataFrame:
        return self.query(f"SELECT * FROM {name}")

    # --- documents ---

    def bureau_files(self) -> DataFrame:
        return self.feed("bureau_documents").select(
            F.concat(F.lit("landing/aecb/"), "name").alias("path"), F.encode("text", "UTF-8").alias("content")
        )

    def _json_files(self, items: str, column: str, name: str) -> DataFrame:
        """JSON arrays of the items of a hundred customers each: a document is of bounded size."""
        chunk = F.floor(F.col("k") / _JSON_DOCUMENT_KEYS)
        text = F.concat(F.lit("["), F.array_join(F.array_sort(F.collect_list(column)), ","), F.lit("]"))
        return (
            self.feed(items)
            .groupBy(chunk.alias("chunk"))
            .agg(F.encode(text, "UTF-8").alias("content"))
            .select(
                F.concat(F.lit(f"landing/{name}_"), F.lpad(F.col("chunk").cast("string"), 9, "0"), F.lit(".json")).alias("path"),
                "content",
            )
        )

    def fraud_files(self, dirty: bool = False) -> DataFrame:
        return self._json_files("fraud_items", "dirty_item" if dirty else "item", "fraud/scores")

    def aml_files(self) -> DataFrame:
        return self._json_files("aml_items", "item", "aml/callbacks")

    def record_files(self, items: str, column: str, source: str) -> DataFrame:
        """The items written with one record per line and read back as a splittable feed: (line, raw_path, position, ingest_run_id)."""
        landing = scratch_path(self.spark, "landing")
        self.feed(items).select(F.col(column).alias("value")).write.text(f"{landing}/{source}")
        parts = self.spark.read.text(f"{landing}/{source}")
        meta = F.col("_metadata")
        row = F.struct(meta["file_block_start"].alias("block"), F.monotonically_increasing_id().alias("row"))
        return parts.select(F.col("value").alias("line"), meta["file_name"].alias("raw_path"), row.alias("position"), F.lit(RUN_ID).alias("ingest_run_id"))

    def deliver(self, folder: str, part: str) -> None:
        """Write the documents of some customers below `folder`, each to a file of its own: every report, and screenings
        and scores in JSON arrays of a hundred customers."""
        bureau = f"SELECT text AS value FROM bureau_documents WHERE {part}"
        arrays = "SELECT '[' || array_join(array_sort(collect_list(item)), ',') || ']' AS value FROM {items} WHERE {part} GROUP BY floor(k / 100)"
        lists = {FRAUD: "fraud_items", AML: "aml_items"}
        queries = {BUREAU: bureau} | {source: arrays.format(items=items, part=part) for source, items in lists.items()}
        for source, sql in queries.items():
            write_each(self.query(sql), f"{folder}/{source}")

    def array_files(self, items: str, column: str, source: str) -> DataFrame:
        """The items written as JSON arrays, one per task whatever its size, and read back element by element: (line, raw_path,
        position, ingest_run_id). Each item also holds an object and a text full of brackets, braces and quotes."""
        landing = scratch_path(self.spark, "landing")
        tricky = F.concat(F.lit(_TRICKY), F.expr(f"substr({column}, 2)"))
        self.feed(items).select(tricky.alias("value")).mapInArrow(_in_brackets, "value string").write.text(f"{landing}/{source}")
        elements = scan_array_elements(self.spark, f"{landing}/{source}", "*.txt")
        return elements.select("line", F.col("name").alias("raw_path"), "position", F.lit(RUN_ID).alias("ingest_run_id"))

    def landed(self, source: str, files: DataFrame) -> DataFrame:
        return bronze.envelopes(files, source, RUN_ID, AS_OF)

    def batch(self) -> DataFrame:
        """One landed batch of bureau, fraud and AML files."""
        return (
            self.landed(BUREAU, self.bureau_files())
            .unionByName(self.landed(FRAUD, self.fraud_files()))
            .unionByName(self.landed(AML, self.aml_files()))
        )

    # --- silver ---

    def _typed(self, feed: str, folder: str, ordinal: str = "0") -> DataFrame:
        row = F.expr(f"CAST({ordinal} AS BIGINT) * 1000000000000 + k")
        return (
            self.feed(feed)
            .withColumn("raw_path", F.lit(folder))
            .withColumn("position", F.struct(F.lit(0).cast("bigint").alias("block"), row.alias("row")))
            .withColumn("ingest_run_id", F.lit(RUN_ID))
            .drop("k", "ordinal")
        )

    def profile(self) -> DataFrame:
        users = self._typed("users", "profile").drop("ingest_run_id")
        return silver.parse_profile(users, self.feed("applications"), self.feed("instalments"), RUN_ID).rows

    def bureau(self, dirty: bool = False) -> DataFrame:
        rows = self._typed("bureau_feed", "aecb")
        if dirty:
            rows = rows.withColumn("report_date", F.col("report_date_dirty"))
        return rows.drop("report_date_dirty")

    def fraud(self) -> DataFrame:
        rows = self._typed("fraud_feed", "fraud", "ordinal")
        stranger = F.col("provider_ref").startswith("frd_str_")
        return (
            rows.withColumn("raw_path", F.when(stranger, "fraud/strangers").otherwise(F.col("raw_path")))
            .withColumn("reason_codes", _listed("codes"))
            .withColumn("model_version", F.lit("v3.2.1"))
            .withColumn("scored_at", F.lit("2024-01-31 12:00:00").cast("timestamp"))
            .drop("codes")
        )

    def aml(self) -> DataFrame:
        rows = self._typed("aml_feed", "aml")
        return (
            rows.withColumn("matched_lists", _listed("lists"))
            .withColumn("received_at", F.col("received_at").cast("timestamp"))
            .drop("lists")
        )

    def silver(self) -> dict[str, DataFrame]:
        return {PROFILE: self.profile(), BUREAU: self.bureau(), FRAUD: self.fraud(), AML: self.aml()}


def _listed(name: str):
    return F.filter(F.split(name, ","), lambda x: x != "")

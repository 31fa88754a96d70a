"""Declared schemas (DDL text) of every table and feed; nothing is inferred from data."""

from __future__ import annotations

# Where a record stood in its feed: the file, the split's byte offset and the row inside it.
# Ordering by (raw_path, position) is the arrival order used by first-wins and last-wins.
_ORIGIN = "raw_path string, position struct<block:bigint,row:bigint>"

BRONZE = (
    "source_event_id string, ingest_run_id string, received_at timestamp, content_sha256 string,"
    " raw_path string, payload_format string, content binary, source string, ingest_date string"
)

BRONZE_RECORDS = (
    "ingest_run_id string, received_at timestamp, content_sha256 string, " + _ORIGIN + ", line string, source string, ingest_date string"
)

SILVER_PROFILE = (
    "internal_uuid string, emirates_id string, first_name string, last_name string, full_name string,"
    " dob string, phone string, email string, emirate string, kyc_verified_at timestamp,"
    " is_new_user boolean, had_overdue_before boolean, ingest_run_id string, " + _ORIGIN
)

SILVER_BUREAU = (
    "report_id string, cb_subject_id string, report_date string, emirates_id string, full_name string,"
    " dob string, nationality string, credit_score int, score_range string, payment_order_flag boolean,"
    " num_bounced_cheques int, total_bounced_cheques_amount double, num_court_cases int,"
    " num_open_court_cases int, total_claim_amount double, gross_annual_income double,"
    " ingest_run_id string, " + _ORIGIN
)

SILVER_FRAUD = (
    "provider_ref string, emirates_id string, phone string, email string, score int, decision string,"
    " reason_codes array<string>, model_version string, scored_at timestamp, ingest_run_id string, "
    + _ORIGIN
)

SILVER_AML = (
    "callback_id string, emirates_id string, full_name string, dob string, status string,"
    " matched_lists array<string>, received_at timestamp, ingest_run_id string, " + _ORIGIN
)

ER_LINK = (
    "source string, source_event_id string, emirates_id string, match_tier string, confidence double,"
    " resolved_at timestamp, notes string"
)

CONFLICT = (
    "emirates_id string, field string, winning_source string, winning_value string,"
    " losing_source string, losing_value string, logged_at timestamp"
)

VECTOR = (
    "emirates_id string, product string, as_of_ts timestamp, full_name string, dob string, phone string,"
    " email string, emirate string, kyc_age_days int, is_new_user boolean, had_overdue_before boolean,"
    " credit_score int, score_range string, payment_order_flag boolean, num_bounced_cheques int,"
    " total_bounced_cheques_amount double, num_court_cases int, num_open_court_cases int,"
    " total_claim_amount double, gross_annual_income double, aecb_available boolean, fraud_score int,"
    " fraud_decision string, fraud_reason_codes array<string>, fraud_available boolean,"
    " aml_status string, aml_matched_lists array<string>, aml_available boolean,"
    " aml_stale_seconds bigint"
)

FACT_DECISION = (
    "decision_id string, emirates_id string, product string, decision_ts timestamp, outcome string,"
    " reason_codes array<string>, engine_version string, rule_pack_version string, credit_score int,"
    " fraud_score int, aml_status string"
)

SNAPSHOT_INDEX = (
    "segment bigint, seq bigint, shards bigint, decision_id string, emirates_id string,"
    " decision_ts string, outcome string, feature_vector_sha256 string, prev_snapshot_sha256 string,"
    " this_snapshot_sha256 string, engine_version string, rule_pack_version string,"
    " pipeline_version string, dt string, product string, batch bigint"
)

SNAPSHOT_BODY = (
    "decision_id string, emirates_id string, decision_ts string, outcome string,"
    " reason_codes array<string>, engine_version string, rule_pack_version string,"
    " pipeline_version string, feature_vector_sha256 string, feature_vector_path string,"
    " prev_snapshot_sha256 string, this_snapshot_sha256 string, dt string, product string, batch bigint"
)

FEATURE_VECTORS = "sha256 string, json string, prefix string"

DQ_RESULT = (
    "rule_id string, severity string, source string, description string, checked bigint,"
    " failed bigint, fail_ratio double, threshold double, breached boolean, status string,"
    " sample_failures string, evaluated_at timestamp, run_id string"
)

# --- feeds as delivered: every leaf is text, so that one bad value never hides a whole record ---

FRAUD_ITEM = (
    "provider_ref string, emirates_id string, phone string, email string, score string,"
    " decision string, reason_codes array<string>, model_version string, scored_at string"
)

AML_ITEM = (
    "callback_id string, emirates_id string, full_name string, dob string, status string,"
    " matched_lists array<string>, received_at string"
)

_INDIVIDUAL = (
    "struct<NameEN:struct<FirstName:string,LastName:string>,FullNameEN:string,DOB:string,"
    "Nationality:string,EmiratesId:string>"
)
BUREAU_DOCUMENT = (
    "Header struct<MessageResponse:struct<_MTs:string>>,"
    " Body struct<MGResponse:struct<MGResponse:struct<NAE_RES:struct<"
    "ResponseId:string,"
    "NewApplication:struct<CBContractId:string>,"
    f"EnquiredSubject:struct<Individual:{_INDIVIDUAL}>,"
    "Response:struct<"
    f"MatchedSubject:struct<CBSubjectId:string,Individual:{_INDIVIDUAL}>,"
    "EmploymentHistory:array<struct<UpdateInfo:array<struct<DateOfUpdate:string>>,"
    "EmploymentInfo:struct<GrossAnnualIncome:string,ActualFlag:string>>>,"
    "PaymentOrder:array<struct<Severity:string,Amount:string>>,"
    "Cases:array<struct<CaseStatusCode:string,InitialTotalClaimAmount:string>>,"
    "Score:struct<Data:struct<Index:string,Range:string>,PaymentOrderFlag:string>>>>>>,"
    " _corrupt_record string"
)

USERS = (
    "internal_uuid string, emirates_id string, first_name string, last_name string, full_name string,"
    " dob string, phone string, email string, emirate string, kyc_verified_at string"
)
APPLICATIONS = (
    "application_id string, internal_uuid string, product string, amount double, decision string,"
    " applied_at string"
)
INSTALMENTS = (
    "instalment_id string, application_id string, due_date string, amount double, paid_at string,"
    " status string, overdue_days int"
)

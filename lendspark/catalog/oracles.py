"""For each registered query, the same answer in DuckDB SQL over the given tables."""

from __future__ import annotations

from lendspark.catalog.feeds import FEEDS, TABLES
from lendspark.operators.audit import SHARDS

_HASH_SEED = "'dcn_' || substr(sha256('run_check:' || emirates_id || ':' || product), 1, 26)"
_K = "(CAST(substr(emirates_id, 10, 7) AS BIGINT) - 1000000)"
_SEGMENT = f"('0x' || substr(sha256(emirates_id), 1, 8))::BIGINT % {SHARDS}"
_VALID = "coalesce(regexp_full_match(emirates_id, '784-[0-9]{4}-[0-9]{7}-[0-9]'), false)"


def _token(c: str) -> str:
    return f"'tok_' || substr(sha256(lower(trim({c}))), 1, 16)"


def _pack(hard_then: str) -> str:
    return f"CASE WHEN hard <> '' THEN 'DECLINE|' || hard {hard_then} ELSE 'APPROVE|ALL_CHECKS_PASSED' END"


_PF = _pack("""
 WHEN had_overdue_before THEN 'DECLINE|INTERNAL_OVERDUE_HISTORY'
 WHEN credit_score IS NULL OR credit_score < 650 THEN 'DECLINE|CREDIT_SCORE_BELOW_650'
 WHEN num_bounced_cheques >= 1 THEN 'DECLINE|BOUNCED_CHEQUE_HISTORY'
 WHEN gross_annual_income < 60000 THEN 'DECLINE|INCOME_BELOW_60000'
 WHEN kyc_age_days < 60 THEN 'REFER|KYC_TOO_NEW'
 WHEN is_new_user THEN 'REFER|NEW_USER_ON_PLATFORM'
 WHEN fraud_score > 400 THEN 'REFER|FRAUD_SCORE_ABOVE_400'
 WHEN refer <> '' THEN 'REFER|' || refer""")
_BNPL = _pack("""
 WHEN NOT aml_available THEN 'REFER|AML_PENDING'
 WHEN aml_status = 'REVIEW' THEN 'REFER|AML_REVIEW'
 WHEN fraud_score > 600 THEN 'REFER|FRAUD_SCORE_ABOVE_600'
 WHEN aecb_available AND credit_score < 550 THEN 'DECLINE|CREDIT_SCORE_BELOW_550'
 WHEN aecb_available AND num_bounced_cheques >= 2 THEN 'DECLINE|MULTIPLE_BOUNCED_CHEQUES'
 WHEN fraud_decision = 'REVIEW' THEN 'REFER|FRAUD_REVIEW'""")
_CCA = _pack("""
 WHEN NOT aecb_available THEN 'REFER|AECB_MISSING'
 WHEN credit_score < 600 THEN 'DECLINE|CREDIT_SCORE_BELOW_600'
 WHEN num_bounced_cheques >= 2 THEN 'DECLINE|MULTIPLE_BOUNCED_CHEQUES'
 WHEN kyc_age_days < 30 THEN 'REFER|KYC_TOO_NEW'
 WHEN fraud_score > 500 THEN 'REFER|FRAUD_SCORE_ABOVE_500'
 WHEN refer <> '' THEN 'REFER|' || refer""")


def _assembled(bureau: str, fraud: str, aml: str) -> str:
    return f"""
SELECT p.emirates_id, product, TIMESTAMP '2024-02-01 00:00:00' AS as_of_ts, p.full_name, p.dob, p.phone, p.email, p.emirate,
       CAST(floor((epoch_us(TIMESTAMP '2024-02-01 00:00:00') - epoch_us(p.kyc_verified_at)) / 86400000000) AS INT) AS kyc_age_days,
       p.is_new_user, p.had_overdue_before, b.credit_score, b.score_range,
       coalesce(b.payment_order_flag, false) AS payment_order_flag, coalesce(b.num_bounced_cheques, 0) AS num_bounced_cheques,
       coalesce(b.total_bounced_cheques_amount, 0.0::DOUBLE) AS total_bounced_cheques_amount,
       coalesce(b.num_court_cases, 0) AS num_court_cases, coalesce(b.num_open_court_cases, 0) AS num_open_court_cases,
       coalesce(b.total_claim_amount, 0.0::DOUBLE) AS total_claim_amount, b.gross_annual_income, b.k IS NOT NULL AS aecb_available,
       f.score AS fraud_score, f.decision AS fraud_decision, coalesce(f.codes, '') AS fraud_reason_codes, f.k IS NOT NULL AS fraud_available,
       m.status AS aml_status, coalesce(m.lists, '') AS aml_matched_lists, m.k IS NOT NULL AS aml_available,
       CAST((epoch_us(TIMESTAMP '2024-02-01 00:00:00') - epoch_us(m.received_at)) // 1000000 AS BIGINT) AS aml_stale_seconds
FROM profile p
LEFT JOIN ({bureau}) b ON b.emirates_id = p.emirates_id
LEFT JOIN ({fraud}) f ON f.emirates_id = p.emirates_id
LEFT JOIN ({aml}) m ON m.emirates_id = p.emirates_id
CROSS JOIN (VALUES ('personal_finance'), ('bnpl'), ('credit_card_alt')) AS products(product)"""


def _latest(table: str, order: str) -> str:
    return (
        f"SELECT * FROM {table} WHERE emirates_id IS NOT NULL"
        f" QUALIFY row_number() OVER (PARTITION BY emirates_id ORDER BY {order}) = 1"
    )


def _backfilled(feed: str, source: str, event: str) -> str:
    return (
        f"SELECT t.* REPLACE (coalesce(l.resolved_eid, t.emirates_id) AS emirates_id) FROM {feed} t"
        f" LEFT JOIN (SELECT * FROM resolved WHERE source = '{source}' AND match_tier <> 'quarantine') l"
        f" ON l.source_event_id = t.{event}"
    )


_HARD = (
    "concat_ws(',', CASE WHEN aml_status = 'HIT' THEN 'AML_HIT' END, CASE WHEN fraud_decision = 'FAIL' THEN 'FRAUD_FAIL' END,"
    " CASE WHEN payment_order_flag AND num_bounced_cheques >= 3 THEN 'MULTIPLE_BOUNCED_CHEQUES' END,"
    " CASE WHEN num_open_court_cases > 0 THEN 'OPEN_COURT_CASE' END)"
)
_REFER = (
    "concat_ws(',', CASE WHEN NOT aecb_available THEN 'AECB_MISSING' END, CASE WHEN NOT aml_available THEN 'AML_PENDING' END,"
    " CASE WHEN aml_status = 'REVIEW' THEN 'AML_REVIEW' END, CASE WHEN fraud_decision = 'REVIEW' THEN 'FRAUD_REVIEW' END)"
)


def _json_list(c: str) -> str:
    return f"CASE WHEN {c} = '' THEN []::VARCHAR[] ELSE string_split({c}, ',') END"


_VECTOR_JSON = (
    "CAST(to_json(struct_pack(aecb_available := aecb_available, aml_available := aml_available,"
    f" aml_matched_lists := {_json_list('aml_matched_lists')}, aml_stale_seconds := aml_stale_seconds, aml_status := aml_status,"
    " as_of_ts := '2024-02-01T00:00:00.000000+00:00', credit_score := credit_score,"
    f" dob := {_token('dob')}, email := {_token('email')}, emirate := {_token('emirate')}, emirates_id := emirates_id,"
    " fraud_available := fraud_available, fraud_decision := fraud_decision,"
    f" fraud_reason_codes := {_json_list('fraud_reason_codes')}, fraud_score := fraud_score, full_name := {_token('full_name')},"
    " gross_annual_income := gross_annual_income, had_overdue_before := CAST(had_overdue_before AS INT), is_new_user := CAST(is_new_user AS INT),"
    " kyc_age_days := kyc_age_days, num_bounced_cheques := num_bounced_cheques, num_court_cases := num_court_cases,"
    f" num_open_court_cases := num_open_court_cases, payment_order_flag := CAST(payment_order_flag AS INT), phone := {_token('phone')},"
    " product := product, score_range := score_range, total_bounced_cheques_amount := total_bounced_cheques_amount,"
    " total_claim_amount := total_claim_amount)) AS VARCHAR)"
)

# Canonical body text around the pointer, written out by hand.
_HEAD = (
    """'{"decision_id":"' || decision_id || '","decision_ts":"2024-02-01T00:00:00.000000+00:00","emirates_id":"' || emirates_id"""
    """ || '","engine_version":"v1.0.0","feature_vector_path":"audit/feature_vectors/' || substr(vector_sha, 1, 2) || '/' || vector_sha"""
    """ || '.json","feature_vector_sha256":"' || vector_sha || '","outcome":"' || outcome"""
    """ || '","pipeline_version":"0.1.0","prev_snapshot_sha256":"'"""
)
_TAIL = (
    """'","product":"' || product || '","reason_codes":["' || replace(reason_codes, ',', '","') || '"],"rule_pack_version":"' """
    """|| rule_pack_version || '"}'"""
)

_STRONG = (
    "SELECT a.name, a.dob, count(*) AS hits, max(p.emirates_id) AS eid,"
    " max(jaro_winkler_similarity(a.name, lower(p.full_name))) AS score"
    " FROM (SELECT DISTINCT lower(full_name) AS name, dob FROM rest2 WHERE full_name IS NOT NULL AND dob IS NOT NULL) a"
    " JOIN users p ON p.dob = a.dob AND jaro_winkler_similarity(a.name, lower(p.full_name)) >= 0.92 GROUP BY ALL"
)

_STEPS = {
    "late_apps": "SELECT DISTINCT application_id FROM instalments WHERE status IN ('OVERDUE', 'PAID_LATE')",
    "history": "SELECT internal_uuid, count(*) AS apps, count(l.application_id) AS late FROM applications a"
    " LEFT JOIN late_apps l USING (application_id) GROUP BY internal_uuid",
    "profile": "SELECT u.*, h.apps IS NULL AS is_new_user, coalesce(h.late > 0, false) AS had_overdue_before"
    " FROM users u LEFT JOIN history h USING (internal_uuid)",
    "vectors": _assembled(
        "SELECT * FROM bureau_feed WHERE emirates_id IS NOT NULL",
        _latest("fraud_feed", "ordinal DESC"),
        "SELECT * FROM aml_feed WHERE emirates_id IS NOT NULL",
    ),
    "signals": f"SELECT *, {_HARD} AS hard, {_REFER} AS refer FROM vectors",
    "answers": f"SELECT *, CASE product WHEN 'personal_finance' THEN {_PF} WHEN 'bnpl' THEN {_BNPL} ELSE {_CCA} END AS answer FROM signals",
    "decided": f"SELECT *, {_HASH_SEED} AS decision_id, split_part(answer, '|', 1) AS outcome, split_part(answer, '|', 2) AS reason_codes,"
    " CASE product WHEN 'personal_finance' THEN 'pf_v1.1.0' WHEN 'bnpl' THEN 'bnpl_v1.1.0' ELSE 'cca_v1.1.0' END AS rule_pack_version"
    " FROM answers",
    # entity resolution
    "inputs": """
SELECT 'profile' AS source, internal_uuid AS source_event_id, emirates_id, phone, lower(email) AS email, full_name, dob FROM users
UNION ALL SELECT 'aecb', report_id, emirates_id, NULL, NULL, full_name, dob FROM bureau_feed
UNION ALL SELECT 'fraud', provider_ref, emirates_id, phone, email, NULL, NULL FROM fraud_feed
UNION ALL SELECT 'aml', callback_id, emirates_id, NULL, NULL, full_name, dob FROM aml_feed""",
    "tier1": f"SELECT * FROM inputs WHERE {_VALID} AND (source IN ('profile', 'aecb') OR emirates_id IN (SELECT emirates_id FROM users))",
    "rest1": "SELECT * FROM inputs ANTI JOIN tier1 USING (source, source_event_id)",
    "tier2": "SELECT r.*, u.emirates_id AS eid FROM rest1 r JOIN users u ON u.phone = r.phone AND u.email = lower(r.email)",
    "rest2": "SELECT * FROM rest1 ANTI JOIN tier2 USING (source, source_event_id)",
    "strong": _STRONG,
    "tier3": "SELECT r.*, s.eid, s.score FROM rest2 r JOIN strong s ON s.name = lower(r.full_name) AND s.dob = r.dob WHERE s.hits = 1",
    "resolved": """
SELECT source, source_event_id, emirates_id AS resolved_eid, 'eid_exact' AS match_tier, 1.0::DOUBLE AS confidence, CAST(NULL AS VARCHAR) AS notes FROM tier1
UNION ALL SELECT source, source_event_id, eid, 'phone_email_exact', 0.95, 'backfilled emirates_id from profile' FROM tier2
UNION ALL SELECT source, source_event_id, eid, 'name_dob_fuzzy', round(score, 3), printf('jaro-winkler=%.3f, backfilled emirates_id', score) FROM tier3
UNION ALL SELECT source, source_event_id, coalesce(emirates_id, ''), 'quarantine', 0.0, 'no match in any tier'
FROM (SELECT * FROM rest2 ANTI JOIN tier3 USING (source, source_event_id))""",
    "links": "SELECT source, source_event_id, resolved_eid AS emirates_id, match_tier, confidence, '2024-02-01 00:00:00' AS resolved_at, notes"
    " FROM resolved WHERE match_tier <> 'quarantine' OR source = 'profile'",
    "lost": "SELECT * FROM resolved WHERE match_tier = 'quarantine' AND source <> 'profile'",
    # data quality; rows fail by rule
    "phones": "SELECT f.emirates_id, f.phone <> p.phone AS differs FROM fraud_feed f JOIN users p ON p.emirates_id = f.emirates_id",
    "measured": f"""
SELECT 'eid_format' AS rule_id, 'MUST_PASS' AS severity, 'profile' AS source,
       'Emirates ID must match 784-YYYY-NNNNNNN-C after normalisation.' AS description,
       count(*) AS checked, count(*) FILTER (NOT {_VALID}) AS failed, 0.0::DOUBLE AS threshold FROM users
UNION ALL SELECT 'fraud_score_range', 'MUST_PASS', 'fraud', 'Fraud score must be in [0, 1000].',
       count(*), count(*) FILTER (score IS NULL OR score NOT BETWEEN 0 AND 1000), 0.0 FROM fraud_feed
UNION ALL SELECT 'aml_status_enum', 'MUST_PASS', 'aml', 'AML status must be one of CLEAR, REVIEW, HIT.',
       count(*), count(*) FILTER (status NOT IN ('CLEAR', 'REVIEW', 'HIT')), 0.0 FROM aml_feed
UNION ALL SELECT 'profile_dob_plausible', 'MUST_PASS', 'profile', 'DOB must be between 1900-01-01 and today − 18 years.',
       count(*), count(*) FILTER (CAST(dob AS DATE) NOT BETWEEN DATE '1900-01-01' AND DATE '2006-02-01'), 0.0 FROM users
UNION ALL SELECT 'aecb_freshness_30d', 'MUST_PASS', 'aecb', 'Latest AECB report must be within 30 days.',
       count(*), count(*) FILTER (CAST(report_date_dirty AS DATE) < DATE '2024-01-02'), 0.0 FROM bureau_feed
UNION ALL SELECT 'aml_coverage', 'WARN', 'aml', 'At most 5% of profile customers may be missing an AML callback.',
       count(DISTINCT emirates_id), count(DISTINCT emirates_id) FILTER (emirates_id NOT IN (SELECT emirates_id FROM aml_feed WHERE emirates_id IS NOT NULL)),
       0.05 FROM users
UNION ALL SELECT 'fraud_phone_conflict', 'WARN', 'fraud', 'Phone mismatch between fraud and profile should be rare.',
       count(*), count(*) FILTER (differs), 0.15 FROM phones
UNION ALL SELECT 'er_quarantine_rate', 'WARN', 'er', 'At most 2% of records should land in entity resolution quarantine.',
       (SELECT count(*) FROM links) + (SELECT count(*) FROM lost), (SELECT count(*) FROM lost), 0.02""",
    "results": """
SELECT rule_id, severity, source, description, CAST(checked AS BIGINT) AS checked, CAST(failed AS BIGINT) AS failed,
       CASE WHEN checked = 0 THEN 0.0 ELSE round(failed / checked, 4) END AS fail_ratio, CAST(threshold AS DOUBLE) AS threshold,
       CASE WHEN checked = 0 THEN false ELSE failed / checked > threshold END AS breached,
       CASE WHEN checked = 0 OR failed / checked <= threshold THEN 'PASS' WHEN severity = 'MUST_PASS' THEN 'FAIL' ELSE 'WARN' END AS status
FROM measured""",
    # audit
    "hashed": f"SELECT *, sha256({_VECTOR_JSON}) AS vector_sha FROM decided",
    "segmented": f"SELECT h.*, CAST({_SEGMENT} AS BIGINT) AS segment FROM hashed h",
    "placed": "SELECT *, row_number() OVER (PARTITION BY product, segment ORDER BY decision_id) AS seq,"
    f" {_HEAD} AS head, {_TAIL} AS tail FROM segmented",
}

_CHAINED = {
    "digests": "SELECT product, segment, row_number() OVER (PARTITION BY product ORDER BY segment) AS nth,"
    " sha256(string_agg(sha256(head || tail), '' ORDER BY seq)) AS digest FROM placed GROUP BY product, segment",
    "anchors": "SELECT product, segment, nth, digest, repeat('0', 64) AS anchor FROM digests WHERE nth = 1"
    " UNION ALL SELECT d.product, d.segment, d.nth, d.digest, sha256(a.anchor || a.digest)"
    " FROM anchors a JOIN digests d ON d.product = a.product AND d.nth = a.nth + 1",
    "chain": "SELECT p.product, p.segment, p.seq, p.decision_id, p.vector_sha, a.anchor AS prev, sha256(p.head || a.anchor || p.tail) AS this"
    " FROM placed p JOIN anchors a USING (product, segment) WHERE p.seq = 1"
    " UNION ALL SELECT p.product, p.segment, p.seq, p.decision_id, p.vector_sha, c.this, sha256(p.head || c.this || p.tail)"
    " FROM chain c JOIN placed p ON p.product = c.product AND p.segment = c.segment AND p.seq = c.seq + 1",
}

# One chain per product, row by row.
_PLAIN = {
    "in_line": "SELECT product, decision_id, head, tail, row_number() OVER (PARTITION BY product ORDER BY decision_id) AS seq FROM placed",
    "plain": "SELECT product, seq, decision_id, repeat('0', 64) AS prev, sha256(head || repeat('0', 64) || tail) AS this FROM in_line WHERE seq = 1"
    " UNION ALL SELECT n.product, n.seq, n.decision_id, p.this, sha256(n.head || p.this || n.tail)"
    " FROM plain p JOIN in_line n ON n.product = p.product AND n.seq = p.seq + 1",
}

# Two batches, by odd and even customers; which of their segments were touched afterwards.
_TREE = {
    "halves": f"SELECT product, {_K} % 100 AS k, CAST({_K} % 2 + 1 AS BIGINT) AS batch, CAST({_SEGMENT} AS BIGINT) AS own FROM decided",
    "ends": "SELECT product, max(own) AS last FROM halves WHERE batch = 1 GROUP BY product",
    "in_tree": "SELECT h.*, CASE WHEN batch = 1 THEN own ELSE coalesce(last, -1) + 1 + own END AS segment FROM halves h LEFT JOIN ends USING (product)",
    "cut_off": "SELECT max(segment) AS segment FROM in_tree WHERE product = 'bnpl'",
    "tree_issues": "SELECT t.product, t.batch, t.segment,"
    " CASE WHEN t.product = 'bnpl' AND t.segment = (SELECT segment FROM cut_off) THEN 'segment_missing' ELSE 'segment_altered' END AS kind"
    " FROM in_tree t GROUP BY ALL HAVING bool_or(k IN (7, 12)) OR kind = 'segment_missing'",
}

# What was done to the stored chains, and hence which issues must be found.
_ISSUES = {
    "marked": f"SELECT *, {_K} % 100 = 7 AS flipped, {_K} % 100 = 13 AS gone, {_K} % 100 = 21 AS edited FROM placed",
    "dense": "SELECT product, segment, row_number() OVER (PARTITION BY product ORDER BY segment) AS nth, bool_or(flipped OR gone) AS touched"
    " FROM marked GROUP BY product, segment",
    "before": "SELECT m.*, lag(m.gone) OVER (PARTITION BY m.product, m.segment ORDER BY m.seq) AS gap, d.nth, p.touched AS touched_before"
    " FROM marked m JOIN dense d USING (product, segment) LEFT JOIN dense p ON p.product = d.product AND p.nth = d.nth - 1",
    "issues": """
SELECT decision_id, product, 'missing_file' AS kind FROM marked WHERE gone
UNION ALL SELECT decision_id, product, 'hash_mismatch' FROM marked WHERE flipped
UNION ALL SELECT decision_id, product, 'vector_mismatch' FROM marked WHERE edited AND NOT gone AND credit_score IS NOT NULL
UNION ALL SELECT decision_id, product, 'vector_mismatch' FROM marked WHERE edited AND NOT gone AND credit_score IS NULL
UNION ALL SELECT decision_id, product, 'chain_break' FROM before
WHERE NOT gone AND (coalesce(gap, false) OR (seq = 1 AND coalesce(touched_before, false)))""",
}


def _with(query: str, extra: dict[str, str] | None = None) -> str:
    names = {t: t for t in TABLES} | {"cores": "1"}
    feeds = [f"{name} AS ({text.format(**names)})" for name, text in FEEDS.items()]
    steps = [f"{name} AS ({text})" for name, text in (_STEPS | (extra or {})).items()]
    return f"WITH RECURSIVE {', '.join(feeds + steps)} {query}"


_PARSED = "bureau_feed WHERE k % 97 NOT IN (5, 6) OR false"
_REPORT_ID = "CASE WHEN k % 9 = 0 THEN 'r' || k ELSE report_id END"
# every document that parses, the duplicates of every 97th included
_READ = (
    "(SELECT * FROM bureau_feed WHERE k % 97 NOT IN (5, 6) UNION ALL SELECT * FROM bureau_feed WHERE k % 97 = 7)"
)

_FILES = """(
SELECT 'aecb' AS source, name, text, 'xml' AS fmt FROM bureau_documents
UNION ALL SELECT 'fraud', 'scores_' || lpad(CAST(k // 100 AS VARCHAR), 9, '0') || '.json', '[' || string_agg(item, ',' ORDER BY item) || ']', 'json'
FROM fraud_items GROUP BY k // 100
UNION ALL SELECT 'aml', 'callbacks_' || lpad(CAST(k // 100 AS VARCHAR), 9, '0') || '.json', '[' || string_agg(item, ',' ORDER BY item) || ']', 'json'
FROM aml_items GROUP BY k // 100)"""

_RUN = "CASE WHEN k % 3 = 0 THEN 'second' ELSE 'first' END"
_DELIVERED = f"""(
SELECT 'aecb' AS source, {_RUN} AS run, text FROM bureau_documents
UNION ALL SELECT 'fraud', {_RUN}, '[' || string_agg(item, ',' ORDER BY item) || ']' FROM fraud_items GROUP BY k // 100, 2
UNION ALL SELECT 'aml', {_RUN}, '[' || string_agg(item, ',' ORDER BY item) || ']' FROM aml_items GROUP BY k // 100, 2)"""

_FACT_COLUMNS = (
    "decision_id, emirates_id, product, '2024-02-01 00:00:00' AS decision_ts, outcome, reason_codes, 'v1.0.0' AS engine_version,"
    " rule_pack_version, credit_score, fraud_score, aml_status"
)
_VECTOR_COLUMNS = "* REPLACE (strftime(as_of_ts, '%Y-%m-%d %H:%M:%S') AS as_of_ts)"
_SHARE = "round(count(*) FILTER (outcome = '{0}') / count(*), 4)"
_BACKFILLED = _assembled(
    _backfilled("bureau_feed", "aecb", "report_id"),
    _latest(f"({_backfilled('fraud_feed', 'fraud', 'provider_ref')})", "ordinal DESC, k DESC"),
    _latest(f"({_backfilled('aml_feed', 'aml', 'callback_id')})", "k DESC"),
)


def _rule(rule_id: str) -> str:
    return _with(
        "SELECT rule_id, severity, checked, failed, fail_ratio, threshold, breached, status FROM results"
        f" WHERE rule_id = '{rule_id}'"
    )


def _conflict(field: str, loser: str, table: str, form: str) -> str:
    a, b = form.format(f"p.{field}"), form.format(f"s.{field}")
    return (
        f"SELECT p.emirates_id, '{field}' AS field, 'profile' AS winning_source, p.{field} AS winning_value, '{loser}' AS losing_source,"
        f" s.{field} AS losing_value, '2024-02-01 00:00:00' AS logged_at FROM users p JOIN ({table}) s ON s.emirates_id = p.emirates_id"
        f" WHERE coalesce(p.{field}, '') <> '' AND coalesce(s.{field}, '') <> '' AND {a} <> {b}"
    )


_FIRST_FRAUD = _latest("fraud_feed", "ordinal")
_SAMPLE = (
    "SELECT rule_id, CAST(row_number() OVER (PARTITION BY rule_id ORDER BY key) - 1 AS INT) AS position, key FROM ("
    "SELECT 'aecb_freshness_30d' AS rule_id, report_id AS key FROM bureau_feed WHERE CAST(report_date_dirty AS DATE) < DATE '2024-01-02'"
    " UNION ALL SELECT 'aml_coverage', emirates_id FROM users WHERE emirates_id NOT IN (SELECT emirates_id FROM aml_feed WHERE emirates_id IS NOT NULL)"
    " UNION ALL SELECT DISTINCT 'fraud_phone_conflict', emirates_id FROM phones WHERE differs"
    " UNION ALL SELECT 'er_quarantine_rate', source_event_id FROM lost"
    ") QUALIFY position < 3"
)

ORACLES: dict[str, str] = {
    "bronze_land": _with(
        "SELECT source, regexp_replace(name, '[.][^.]*$', '') AS source_event_id, sha256(text) AS content_sha256,"
        " 'bronze/' || source || '/ingest_date=2024-02-01/' || substr(sha256(text), 1, 16) || '_' || name AS raw_path, fmt AS payload_format,"
        f" 'run_check' AS ingest_run_id, '2024-02-01' AS ingest_date, '2024-02-01 00:00:00' AS received_at FROM {_FILES}"
    ),
    "bronze_summary": _with(
        f"SELECT source, count(*) AS files_landed, count(DISTINCT sha256(text)) AS unique_hashes FROM {_FILES} GROUP BY source"
    ),
    "bronze_idempotent": _with(
        f"SELECT source, count(*) AS files_landed, count(DISTINCT sha256(text)) AS unique_hashes FROM {_FILES} GROUP BY source"
    ),
    "bronze_incremental": _with(
        f"SELECT source, run AS ingest_run_id, sha256(text || chr(10)) AS content_sha256, count(*) AS files FROM {_DELIVERED} GROUP BY ALL"
    ),
    "parse_bureau_xml": _with(
        f"SELECT {_REPORT_ID} AS report_id, cb_subject_id, report_date, emirates_id, full_name, dob, nationality, credit_score, score_range,"
        " payment_order_flag, num_bounced_cheques, total_bounced_cheques_amount, num_court_cases, num_open_court_cases, total_claim_amount,"
        f" gross_annual_income FROM {_READ}"
    ),
    "bureau_rejects": _with(
        "SELECT 'aecb' AS source, report_id AS source_event_id, CASE WHEN k % 97 = 5 THEN 'malformed XML' ELSE 'no report body' END AS reason"
        " FROM bureau_feed WHERE k % 97 IN (5, 6)"
    ),
    "parse_fraud": _with(
        "SELECT provider_ref, emirates_id, phone, email, score, decision, codes AS reason_codes, 'v3.2.1' AS model_version,"
        " '2024-01-31 12:00:00' AS scored_at FROM fraud_feed"
    ),
    "parse_aml": _with(
        "SELECT callback_id, emirates_id, full_name, dob, status, lists AS matched_lists,"
        " strftime(received_at, '%Y-%m-%d %H:%M:%S') AS received_at FROM aml_feed"
    ),
    "validate_split": _with(
        "SELECT provider_ref, CASE k % 101 WHEN 1 THEN 'score missing' WHEN 2 THEN 'decision not allowed'"
        " WHEN 3 THEN 'model_version missing; decision not allowed' WHEN 4 THEN 'model_version missing' WHEN 5 THEN 'scored_at missing'"
        " ELSE 'valid' END AS verdict FROM fraud_feed"
    ),
    "profile_features": _with(
        "SELECT internal_uuid, emirates_id, first_name, last_name, full_name, dob, phone, email, emirate,"
        " strftime(kyc_verified_at, '%Y-%m-%d %H:%M:%S') AS kyc_verified_at, is_new_user, had_overdue_before FROM profile"
    ),
    "normalise_ids": _with("SELECT provider_ref, upper(emirates_id) AS emirates_id, email FROM fraud_feed"),
    "normalise_dates": _with(
        "SELECT internal_uuid, CASE k % 11 WHEN 0 THEN '31021988' WHEN 1 THEN 'n/a' WHEN 2 THEN '' WHEN 3 THEN '' ELSE dob END AS dob,"
        " CASE k % 11 WHEN 0 THEN '31021988' WHEN 1 THEN 'n/a' WHEN 2 THEN NULL WHEN 3 THEN '' ELSE dob END AS updated FROM users"
    ),
    "safe_casts": _with(
        "SELECT report_id, CASE k % 6 WHEN 0 THEN credit_score WHEN 4 THEN 7 END AS as_int,"
        " CAST(CASE k % 6 WHEN 0 THEN credit_score WHEN 1 THEN 727.0 WHEN 4 THEN 7 ELSE 0 END AS DOUBLE) AS as_float FROM bureau_feed"
    ),
    "eid_valid": _with(f"SELECT provider_ref, {_VALID} AS valid FROM fraud_feed"),
    "tokenise_pii": _with(
        f"SELECT internal_uuid, emirates_id, {_token('full_name')} AS full_name, {_token('phone')} AS phone, {_token('email')} AS email,"
        f" {_token('dob')} AS dob, {_token('emirate')} AS emirate FROM users"
    ),
    "json_roundtrip": _with(
        "SELECT provider_ref, CASE WHEN codes = '' THEN '[]' ELSE '[\"' || replace(codes, ',', '\",\"') || '\"]' END AS stored,"
        " codes AS reason_codes, decision = 'PASS' AS passed FROM fraud_feed"
    ),
    "jaro_winkler": _with(
        "SELECT a.dob, a.name, p.name AS known_name, round(jaro_winkler_similarity(a.name, p.name), 6) AS score"
        " FROM (SELECT DISTINCT dob, lower(full_name) AS name FROM aml_feed) a"
        " JOIN (SELECT DISTINCT dob, lower(full_name) AS name FROM users) p"
        " ON p.dob = a.dob AND jaro_winkler_similarity(a.name, p.name) >= 0.92"
    ),
    "bounced_cheques": _with(
        "SELECT num_bounced_cheques, count(*) AS reports, sum(total_bounced_cheques_amount) AS amount"
        f" FROM {_READ} GROUP BY num_bounced_cheques"
    ),
    "court_cases": _with(
        "SELECT num_court_cases, num_open_court_cases, count(*) AS reports, sum(total_claim_amount) AS claims"
        f" FROM {_READ} GROUP BY num_court_cases, num_open_court_cases"
    ),
    "latest_income": _with(f"SELECT {_REPORT_ID} AS report_id, cb_subject_id, gross_annual_income FROM {_READ}"),
    "er_inputs": _with("SELECT * FROM inputs"),
    "er_links": _with("SELECT * FROM links"),
    "er_tier1": _with("SELECT * FROM resolved WHERE match_tier = 'eid_exact'"),
    "er_tier2": _with("SELECT * FROM links WHERE match_tier = 'phone_email_exact'"),
    "er_tier3": _with("SELECT * FROM links WHERE match_tier = 'name_dob_fuzzy'"),
    "er_hot_birth_date": _with(
        "SELECT w.dob, w.name, n.name AS known_name, round(jaro_winkler_similarity(w.name, n.name), 6) AS score FROM"
        " (SELECT DISTINCT CASE WHEN k % 3 = 0 THEN '1985-05-05' ELSE dob END AS dob, lower(substr(full_name, 1, 1) || substr(full_name, 3, 1)"
        " || substr(full_name, 2, 1) || substr(full_name, 4) || ' ' || emirate) AS name FROM users) w JOIN"
        " (SELECT DISTINCT CASE WHEN k % 3 = 0 THEN '1985-05-05' ELSE dob END AS dob, lower(full_name || ' ' || emirate) AS name FROM users) n"
        " ON w.dob = n.dob AND jaro_winkler_similarity(w.name, n.name) >= 0.92"
    ),
    "er_mint_rule": _with(
        f"SELECT source, source_event_id, CASE WHEN hit OR source = 'aecb' THEN 'eid_exact' END AS match_tier,"
        " CASE WHEN NOT hit AND source = 'aecb' THEN 'new customer (EID not yet in profile index)' END AS notes FROM ("
        f"SELECT *, emirates_id IN (SELECT emirates_id FROM users WHERE k % 10 <> 3) AS hit FROM inputs WHERE {_VALID} AND source <> 'profile')"
    ),
    "er_quarantine": _with(
        "SELECT source, source_event_id, resolved_eid AS emirates_id, match_tier, confidence, notes, source_event_id AS record_id FROM lost"
    ),
    "er_summary": _with("SELECT match_tier, count(*) AS records FROM resolved GROUP BY match_tier"),
    "conflict_log": _with(
        " UNION ALL ".join(
            [
                _conflict("phone", "fraud", _FIRST_FRAUD, "trim({0})"),
                _conflict("email", "fraud", _FIRST_FRAUD, "lower(trim({0}))"),
                _conflict("full_name", "aecb", "SELECT * FROM bureau_feed", "upper(trim({0}))"),
                _conflict("full_name", "aml", "SELECT * FROM aml_feed", "upper(trim({0}))"),
                _conflict("dob", "aecb", "SELECT * FROM bureau_feed", "trim({0})"),
                _conflict("dob", "aml", "SELECT * FROM aml_feed", "trim({0})"),
            ]
        )
    ),
    "latest_per_key": _with(f"SELECT emirates_id, provider_ref, score FROM ({_latest('fraud_feed', 'ordinal DESC')})"),
    "first_per_key": _with(f"SELECT emirates_id, provider_ref, score FROM ({_FIRST_FRAUD})"),
    "silver_counts": _with(
        "SELECT 'profile' AS source, count(*) AS records FROM users UNION ALL SELECT 'aecb', count(*) FROM bureau_feed"
        " UNION ALL SELECT 'fraud', count(*) FROM fraud_feed UNION ALL SELECT 'aml', count(*) FROM aml_feed"
    ),
    "decision_vector": _with(f"SELECT {_VECTOR_COLUMNS} FROM vectors"),
    "decision_vector_backfilled": _with(f"SELECT {_VECTOR_COLUMNS} FROM ({_BACKFILLED})"),
    "vector_summary": _with("SELECT count(*) AS vectors, count(DISTINCT emirates_id) AS customers FROM vectors"),
    "hard_declines": _with("SELECT emirates_id, product, hard AS reasons FROM signals"),
    "refer_signals": _with("SELECT emirates_id, product, refer AS reasons FROM signals"),
    "decide_pf": _with("SELECT emirates_id, outcome, reason_codes FROM decided WHERE product = 'personal_finance'"),
    "decide_bnpl": _with("SELECT emirates_id, outcome, reason_codes FROM decided WHERE product = 'bnpl'"),
    "decide_cca": _with("SELECT emirates_id, outcome, reason_codes FROM decided WHERE product = 'credit_card_alt'"),
    "decisions_by_reason": _with(
        "SELECT product, outcome, reason, count(*) AS given, count(*) FILTER (place = 1) AS given_first FROM (SELECT product, outcome,"
        " unnest(string_split(reason_codes, ',')) AS reason, generate_subscripts(string_split(reason_codes, ','), 1) AS place FROM decided) GROUP BY ALL"
    ),
    "decisions": _with(f"SELECT {_FACT_COLUMNS} FROM decided"),
    "fact_decision": _with(f"SELECT {_FACT_COLUMNS} FROM decided"),
    "dim_customer": _with(
        "SELECT emirates_id, full_name, emirate, strftime(kyc_verified_at, '%Y-%m-%d %H:%M:%S') AS kyc_verified_at FROM users"
    ),
    "dim_product": _with(
        "SELECT product_id, product_name, description, count(*) AS decisions FROM decided JOIN (VALUES"
        " ('personal_finance', 'Personal Finance', 'Unsecured personal loan'),"
        " ('bnpl', 'Buy Now Pay Later', 'Short-term point-of-sale credit'),"
        " ('credit_card_alt', 'Credit Card Alternative', 'Revolving credit facility'))"
        " AS d(product_id, product_name, description) ON product = product_id GROUP BY ALL"
    ),
    "outcome_counts": _with("SELECT outcome, count(*) AS decisions FROM decided GROUP BY outcome"),
    "outcome_by_product": _with(
        "SELECT product, count(*) FILTER (outcome = 'APPROVE') AS APPROVE, count(*) FILTER (outcome = 'DECLINE') AS DECLINE,"
        " count(*) FILTER (outcome = 'REFER') AS REFER FROM decided GROUP BY product"
    ),
    "top_decline_reasons": _with(
        "SELECT reason, count(*) AS declines FROM (SELECT unnest(string_split(reason_codes, ',')) AS reason FROM decided"
        " WHERE outcome = 'DECLINE') GROUP BY reason ORDER BY declines DESC, reason LIMIT 10"
    ),
    "approval_rate": _with(
        "SELECT product, count(*) AS decisions, count(*) FILTER (outcome = 'APPROVE') AS approved,"
        " round(count(*) FILTER (outcome = 'APPROVE') * 100 / count(*), 1) AS approval_rate FROM decided GROUP BY product"
    ),
    "portfolio_kpis": _with(
        "SELECT count(*) AS decisions, count(*) FILTER (outcome = 'APPROVE') AS approve, count(*) FILTER (outcome = 'DECLINE') AS decline,"
        f" count(*) FILTER (outcome = 'REFER') AS refer, {_SHARE.format('APPROVE')} AS approve_share,"
        f" {_SHARE.format('DECLINE')} AS decline_share, {_SHARE.format('REFER')} AS refer_share FROM decided"
    ),
    "score_distribution": _with(
        "SELECT CAST(credit_score // 50 * 50 AS INT) AS score_from, count(*) FILTER (outcome = 'APPROVE') AS APPROVE,"
        " count(*) FILTER (outcome = 'DECLINE') AS DECLINE, count(*) FILTER (outcome = 'REFER') AS REFER"
        " FROM decided WHERE credit_score IS NOT NULL GROUP BY ALL"
    ),
    "decision_lookup": _with(
        "SELECT decision_id, emirates_id, product, outcome, reason_codes FROM decided WHERE product = 'bnpl' AND outcome = 'REFER'"
    ),
    "dq_eid_format": _rule("eid_format"),
    "dq_fraud_score_range": _rule("fraud_score_range"),
    "dq_aml_status_enum": _rule("aml_status_enum"),
    "dq_dob_plausible": _rule("profile_dob_plausible"),
    "dq_bureau_freshness": _rule("aecb_freshness_30d"),
    "dq_aml_coverage": _rule("aml_coverage"),
    "dq_fraud_phone_conflict": _rule("fraud_phone_conflict"),
    "dq_er_quarantine": _rule("er_quarantine_rate"),
    "dq_scorecard": _with(
        "SELECT r.*, coalesce(sample_keys, '') AS sample_keys, '2024-02-01 00:00:00' AS evaluated_at, 'run_check' AS run_id FROM results r"
        f" LEFT JOIN (SELECT rule_id, string_agg(key, ',' ORDER BY position) AS sample_keys FROM ({_SAMPLE}) GROUP BY rule_id) USING (rule_id)"
    ),
    "dq_samples": _with(_SAMPLE),
    "dq_gate": _with(
        "SELECT count(*) FILTER (breached AND severity = 'MUST_PASS') = 0 AS promoted,"
        " count(*) FILTER (breached AND severity = 'MUST_PASS') AS must_pass_breaches,"
        " count(*) FILTER (breached AND severity = 'WARN') AS warn_breaches,"
        " coalesce(string_agg(rule_id, ', ' ORDER BY rule_id) FILTER (breached AND severity = 'MUST_PASS'), '') AS rule_ids FROM results"
    ),
    "dq_summary": _with(
        "SELECT count(*) AS rules, count(*) FILTER (breached AND severity = 'MUST_PASS') AS must_pass_failures,"
        " count(*) FILTER (breached AND severity = 'WARN') AS warnings FROM results"
    ),
    "dq_display": _with(
        "SELECT rule_id, severity, source, description, checked, failed, CAST(round(fail_ratio * 100, 2) AS VARCHAR) || '%' AS fail_ratio,"
        " CAST(round(threshold * 100, 2) AS VARCHAR) || '%' AS threshold, lower(status) AS status FROM results"
    ),
    "dq_persist": _with(
        "SELECT run_id, rule_id, checked, failed, status FROM results CROSS JOIN (VALUES ('run_a'), ('run_b')) AS runs(run_id)"
    ),
    "latest_dq_run": _with(
        "SELECT 'run_b' AS run_id, rule_id, severity, checked, failed, checked > 0 AND failed / checked > threshold AS breached,"
        " CASE WHEN checked = 0 OR failed / checked <= threshold THEN 'PASS' WHEN severity = 'MUST_PASS' THEN 'FAIL' ELSE 'WARN' END AS status"
        " FROM (SELECT * REPLACE (CASE rule_id WHEN 'aecb_freshness_30d' THEN"
        " (SELECT count(*) FROM bureau_feed WHERE CAST(report_date_dirty AS DATE) < DATE '2024-01-07')"
        " WHEN 'profile_dob_plausible' THEN"
        " (SELECT count(*) FROM users WHERE CAST(dob AS DATE) NOT BETWEEN DATE '1900-01-01' AND DATE '2006-02-06')"
        " ELSE failed END AS failed) FROM results)"
    ),
    "vector_hash": _with("SELECT emirates_id, product, vector_sha AS feature_vector_sha256 FROM hashed"),
    "vector_store": _with(
        f"SELECT substr(vector_sha, 1, 2) AS prefix, count(*) AS new_vectors FROM (SELECT DISTINCT vector_sha FROM hashed WHERE {_K} % 2 = 1) GROUP BY ALL"
    ),
    "vector_store_sketch": _with(
        "SELECT substr(vector_sha, 1, 2) AS prefix, count(*) AS new_vectors, CAST(0 AS BIGINT) AS stored_but_not_possible"
        f" FROM (SELECT DISTINCT vector_sha FROM hashed WHERE {_K} % 2 = 1) GROUP BY ALL"
    ),
    "snapshots": _with(
        "SELECT product, segment, seq, decision_id, vector_sha AS feature_vector_sha256, prev AS prev_snapshot_sha256,"
        " this AS this_snapshot_sha256 FROM chain",
        _CHAINED,
    ),
    "snapshots_plain": _with("SELECT product, seq, decision_id, prev AS prev_snapshot_sha256, this AS this_snapshot_sha256 FROM plain", _PLAIN),
    "newest_snapshots": _with(
        "SELECT decision_id, product, '2024-02-01 00:00:00' AS decision_ts FROM decided WHERE outcome = 'DECLINE' ORDER BY decision_id LIMIT 500"
    ),
    "vector_archive": _with(
        "SELECT emirates_id, product, '2024-02-01 00:00:00' AS as_of_ts, credit_score, gross_annual_income, is_new_user, aml_matched_lists FROM vectors"
    ),
    "silver_overwrite": _with("SELECT report_id, emirates_id, report_date, credit_score FROM bureau_feed WHERE credit_score < 600"),
    "audit_reset": _with(
        "SELECT product, count(*) AS snapshots, count(*) AS bodies, CAST(1 AS BIGINT) AS batches, repeat('0', 64) AS genesis,"
        f" (SELECT count(DISTINCT vector_sha) FROM hashed WHERE {_K} % 2 = 1) AS vectors FROM hashed WHERE {_K} % 2 = 1 GROUP BY product"
    ),
    "chain_tree_verify": _with("SELECT product, batch, segment, kind, true AS in_full_check FROM tree_issues", _TREE),
    "chain_heads": _with(
        "SELECT product, this AS head, segment, CAST(1 AS BIGINT) AS batch FROM chain"
        " QUALIFY row_number() OVER (PARTITION BY product ORDER BY segment DESC, seq DESC) = 1",
        _CHAINED,
    ),
    "chain_append": _with(
        "SELECT product, count(*) AS snapshots, count(DISTINCT half) AS batches, count(DISTINCT (half, segment)) AS segments,"
        f" CAST(0 AS BIGINT) AS issues FROM (SELECT product, {_K} % 2 AS half, {_SEGMENT} AS segment FROM decided) GROUP BY product"
    ),
    "chain_append_retry": _with(
        "SELECT product, count(*) AS snapshots, CAST(2 AS BIGINT) AS batches, count(*) AS bodies, CAST(0 AS BIGINT) AS issues FROM decided GROUP BY product"
    ),
    "chain_verify": _with("SELECT * FROM issues", _ISSUES),
    "chain_verify_product": _with("SELECT * FROM issues WHERE product = 'bnpl'", _ISSUES),
    "chain_issue_summary": _with("SELECT kind, count(*) AS issues FROM issues GROUP BY kind", _ISSUES),
    "replay": _with(
        f"SELECT decision_id, product, {_K} % 100 <> 7 AS matches, CASE WHEN {_K} % 100 = 7 THEN 'HOLD' ELSE outcome END AS original_outcome,"
        " outcome AS replayed_outcome, reason_codes AS original_reasons, reason_codes AS replayed_reasons FROM decided"
    ),
    "replay_sample": _with("SELECT decision_id, true AS matches FROM decided ORDER BY sha256('7:' || decision_id), decision_id LIMIT 10"),
    "decision_detail": _with(
        "SELECT decision_id, product, outcome, reason_codes, rule_pack_version, true AS vector_intact, true AS matches, outcome AS replayed_outcome"
        " FROM decided QUALIFY row_number() OVER (PARTITION BY product ORDER BY decision_id) = 1"
    ),
    "replay_pii_invariant": _with("SELECT count(*) AS decisions, CAST(0 AS BIGINT) AS differing FROM decided"),
}

# The same records, delivered as arrays.
ORACLES |= {"parse_fraud_array": ORACLES["parse_fraud"], "parse_aml_array": ORACLES["parse_aml"]}

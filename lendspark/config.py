"""Names, versions and thresholds shared by every layer."""

from __future__ import annotations

# They appear in stored rows and hashes, so they must not change.
PIPELINE_VERSION = "0.1.0"
DECISION_ENGINE_VERSION = "v1.0.0"
GENESIS_HASH = "0" * 64

BUREAU = "aecb"
FRAUD = "fraud"
AML = "aml"
PROFILE = "profile"
SOURCES = (BUREAU, FRAUD, AML, PROFILE)

PERSONAL_FINANCE = "personal_finance"
BNPL = "bnpl"
CREDIT_CARD_ALT = "credit_card_alt"
PRODUCTS = (PERSONAL_FINANCE, BNPL, CREDIT_CARD_ALT)

# product_id, product_name, description
PRODUCT_ROWS = (
    (PERSONAL_FINANCE, "Personal Finance", "Unsecured personal loan"),
    (BNPL, "Buy Now Pay Later", "Short-term point-of-sale credit"),
    (CREDIT_CARD_ALT, "Credit Card Alternative", "Revolving credit facility"),
)

OUTCOMES = ("APPROVE", "DECLINE", "REFER")
FRAUD_DECISIONS = ("PASS", "REVIEW", "FAIL")
AML_STATUSES = ("CLEAR", "REVIEW", "HIT")

# payload format and file pattern of each landing source
SOURCE_FORMATS = {BUREAU: "xml", FRAUD: "json", AML: "json", PROFILE: "sqlite"}
SOURCE_GLOBS = {BUREAU: "*.xml", FRAUD: "*.json", AML: "*.json", PROFILE: "*.db"}

RECORD_GLOB = "*.jsonl"  # feeds with one record per line, of any size
WHOLE_BYTES = 256 << 20  # a larger JSON array is read element by element, as one row could not hold it

EID_PATTERN = r"^784-[0-9]{4}-[0-9]{7}-[0-9]$"
NAME_FUZZY_THRESHOLD = 0.92
PII_FIELDS = ("full_name", "phone", "email", "dob", "emirate")

# Tolerated failure ratio of each WARN rule; MUST_PASS rules tolerate none.
WARN_THRESHOLDS = {
    "aml_coverage": 0.05,
    "fraud_phone_conflict": 0.15,
    "er_quarantine_rate": 0.02,
}

"""Point-in-time feature vectors: one row per customer and product."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendspark.config import AML, BUREAU, FRAUD, PRODUCTS, PROFILE
from lendspark.functions.text import whole_days_between, whole_seconds_between
from lendspark.operators.keyed import latest_per_key
from lendspark.operators.resolve import backfill

VECTOR_COLUMNS = (
    "emirates_id", "product", "as_of_ts",
    "full_name", "dob", "phone", "email", "emirate", "kyc_age_days", "is_new_user", "had_overdue_before",
    "credit_score", "score_range", "payment_order_flag", "num_bounced_cheques",
    "total_bounced_cheques_amount", "num_court_cases", "num_open_court_cases", "total_claim_amount",
    "gross_annual_income", "aecb_available",
    "fraud_score", "fraud_decision", "fraud_reason_codes", "fraud_available",
    "aml_status", "aml_matched_lists", "aml_available", "aml_stale_seconds",
)

_BUREAU_FEATURES = (
    "credit_score", "score_range", "payment_order_flag", "num_bounced_cheques",
    "total_bounced_cheques_amount", "num_court_cases", "num_open_court_cases", "total_claim_amount",
    "gross_annual_income",
)
_DEFAULTS = {
    "payment_order_flag": False,
    "num_bounced_cheques": 0,
    "total_bounced_cheques_amount": 0.0,
    "num_court_cases": 0,
    "num_open_court_cases": 0,
    "total_claim_amount": 0.0,
    "aecb_available": False,
    "fraud_available": False,
    "aml_available": False,
}


def assemble(
    silver: Mapping[str, DataFrame],
    as_of: datetime,
    products: tuple[str, ...] = PRODUCTS,
    resolved: DataFrame | None = None,
) -> DataFrame:
    """Feature vectors from the last record of each source per customer.

    With `resolved`, bureau, fraud and AML rows are first given the Emirates ID that entity
    resolution found for them; without it they count under the ID they were delivered with.
    All four sides are keyed by the same column, so the rank filter's shuffle also serves the joins.
    """
    tables = dict(silver)
    if resolved is not None:
        for source in (BUREAU, FRAUD, AML):
            tables[source] = backfill(tables[source], resolved, source)
    latest = {source: latest_per_key(tables[source], "emirates_id") for source in tables}
    now = F.lit(as_of).cast("timestamp")

    profile = latest[PROFILE].select(
        "emirates_id", "full_name", "dob", "phone", "email", "emirate",
        whole_days_between(now, F.col("kyc_verified_at")).alias("kyc_age_days"),
        F.coalesce("is_new_user", F.lit(False)).alias("is_new_user"),
        F.coalesce("had_overdue_before", F.lit(False)).alias("had_overdue_before"),
    )
    bureau = latest[BUREAU].select("emirates_id", *_BUREAU_FEATURES, F.lit(True).alias("aecb_available"))
    fraud = latest[FRAUD].select(
        "emirates_id",
        F.col("score").alias("fraud_score"),
        F.col("decision").alias("fraud_decision"),
        F.col("reason_codes").alias("fraud_reason_codes"),
        F.lit(True).alias("fraud_available"),
    )
    aml = latest[AML].select(
        "emirates_id",
        F.col("status").alias("aml_status"),
        F.col("matched_lists").alias("aml_matched_lists"),
        F.lit(True).alias("aml_available"),
        whole_seconds_between(now, F.col("received_at")).alias("aml_stale_seconds"),
    )
    wide = profile
    for side in (bureau, fraud, aml):
        wide = wide.join(side, "emirates_id", "left")
    no_codes = F.array().cast("array<string>")
    return (
        wide.fillna(_DEFAULTS)
        .withColumn("fraud_reason_codes", F.coalesce("fraud_reason_codes", no_codes))
        .withColumn("aml_matched_lists", F.coalesce("aml_matched_lists", no_codes))
        .withColumn("as_of_ts", now)
        .withColumn("product", F.explode(F.array(*[F.lit(p) for p in products])))
        .select(*VECTOR_COLUMNS)
    )


def summary(vectors: DataFrame) -> DataFrame:
    """Vectors and distinct customers."""
    return vectors.agg(
        F.count(F.lit(1)).alias("vectors"), F.countDistinct("emirates_id").alias("customers")
    )

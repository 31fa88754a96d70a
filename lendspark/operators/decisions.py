"""Decisions from feature vectors, and the star schema around them."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendspark.config import DECISION_ENGINE_VERSION, PRODUCT_ROWS
from lendspark.operators.packs import PACKS, RulePack, evaluate_current

DECISION_COLUMNS = (
    "decision_id", "emirates_id", "product", "decision_ts", "outcome", "reason_codes",
    "engine_version", "rule_pack_version",
)


def decide(
    vectors: DataFrame, decided_at: datetime, run_id: str, packs: Iterable[RulePack] = PACKS
) -> DataFrame:
    """The vectors with their decision beside them.

    The decision id is derived from run, customer and product, so a recomputed partition repeats it.
    """
    seed = F.concat_ws(":", F.lit(run_id), "emirates_id", "product")
    answer = evaluate_current(F.col("product"), F.col, packs)
    return vectors.select(
        "*",
        F.concat(F.lit("dcn_"), F.substring(F.sha2(seed, 256), 1, 26)).alias("decision_id"),
        F.lit(decided_at).cast("timestamp").alias("decision_ts"),
        F.lit(DECISION_ENGINE_VERSION).alias("engine_version"),
        answer.alias("_answer"),
    ).select("*", "_answer.outcome", "_answer.reason_codes", "_answer.rule_pack_version").drop("_answer")


def fact_decision(decided: DataFrame) -> DataFrame:
    return decided.select(*DECISION_COLUMNS, "credit_score", "fraud_score", "aml_status")


def dim_customer(profiles: DataFrame) -> DataFrame:
    return profiles.select("emirates_id", "full_name", "emirate", "kyc_verified_at")


def dim_product(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PRODUCT_ROWS, "product_id string, product_name string, description string")


def outcome_counts(facts: DataFrame) -> DataFrame:
    return facts.groupBy("outcome").agg(F.count(F.lit(1)).alias("decisions"))

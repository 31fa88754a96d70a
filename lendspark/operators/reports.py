"""Portfolio and data-quality tables behind a dashboard, from the stored facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendspark.config import OUTCOMES
from lendspark.operators.quality import MUST_PASS, WARN

_BUCKET = 50


def _share(part: str, whole: str) -> Column:
    return F.round(F.col(part) / F.nullif(F.col(whole), F.lit(0)), 4)


def portfolio_kpis(facts: DataFrame) -> DataFrame:
    """Totals and shares of each outcome, in one row."""
    counts = facts.agg(
        F.count(F.lit(1)).alias("decisions"),
        *[F.count_if(F.col("outcome") == o).alias(o.lower()) for o in OUTCOMES],
    )
    return counts.withColumns({f"{o.lower()}_share": _share(o.lower(), "decisions") for o in OUTCOMES})


def outcome_by_product(facts: DataFrame) -> DataFrame:
    """Decisions per product, one column per outcome."""
    return facts.groupBy("product").pivot("outcome", list(OUTCOMES)).count().na.fill(0, list(OUTCOMES))


def top_decline_reasons(facts: DataFrame, n: int = 10) -> DataFrame:
    """The `n` most frequent reasons among declines."""
    reasons = facts.where(F.col("outcome") == "DECLINE").select(F.explode("reason_codes").alias("reason"))
    counts = reasons.groupBy("reason").agg(F.count(F.lit(1)).alias("declines"))
    return counts.orderBy(F.desc("declines"), "reason").limit(n)


def approval_rate(facts: DataFrame) -> DataFrame:
    """Decisions, approvals and approval percentage per product."""
    counts = facts.groupBy("product").agg(
        F.count("decision_id").alias("decisions"),
        F.count_if(F.col("outcome") == "APPROVE").alias("approved"),
    )
    return counts.withColumn("approval_rate", F.round(F.col("approved") * 100 / F.col("decisions"), 1))


def score_distribution(facts: DataFrame, width: int = _BUCKET) -> DataFrame:
    """Scored decisions per score bucket, one column per outcome."""
    scored = facts.where(F.col("credit_score").isNotNull())
    bucket = (F.floor(F.col("credit_score") / width) * width).cast("int")
    pivoted = scored.groupBy(bucket.alias("score_from")).pivot("outcome", list(OUTCOMES)).count()
    return pivoted.na.fill(0, list(OUTCOMES))


def latest_dq_run(results: DataFrame) -> DataFrame:
    """All rows of the run evaluated last."""
    last = results.orderBy(F.desc("evaluated_at"), F.desc("run_id")).limit(1).select("run_id")
    return results.join(last, "run_id", "left_semi").orderBy("severity", "rule_id")


def dq_summary(results: DataFrame) -> DataFrame:
    """Rules evaluated, MUST_PASS failures and warnings."""
    return results.agg(
        F.count(F.lit(1)).alias("rules"),
        F.count_if(F.col("breached") & (F.col("severity") == MUST_PASS)).alias("must_pass_failures"),
        F.count_if(F.col("breached") & (F.col("severity") == WARN)).alias("warnings"),
    )


def dq_display(results: DataFrame) -> DataFrame:
    """Results as shown: ratios as percentages, status as one word."""

    def percent(name: str) -> Column:
        return F.concat(F.round(F.col(name) * 100, 2).cast("string"), F.lit("%")).alias(name)

    return results.select(
        "rule_id", "severity", "source", "description", "checked", "failed",
        percent("fail_ratio"), percent("threshold"), F.lower("status").alias("status"),
    )


def breached_rules(results: DataFrame) -> DataFrame:
    """Breached rules with their sample failures."""
    return results.where("breached").select("rule_id", "severity", "sample_failures")


def decision_lookup(
    index: DataFrame,
    product: str | None = None,
    outcome: str | None = None,
    decision_id: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Snapshots by product, outcome or id; with a `limit`, for a list shown to a person, the newest ones in order."""
    found = index
    for name, value in (("product", product), ("outcome", outcome), ("decision_id", decision_id)):
        if value is not None:
            found = found.where(F.col(name) == value)
    return found if limit is None else found.orderBy(F.desc("decision_ts"), "decision_id").limit(limit)

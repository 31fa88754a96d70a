"""Declarative data-quality rules, their scorecard, and the gate before gold.

A `RowRule` is a failing-row predicate on one table; all row rules of a table share one pass over it.
A `TableRule` measures (checked, failed) itself. Both are plain values: add one to the list to extend
the scorecard.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendspark import schemas
from lendspark.config import AML, AML_STATUSES, BUREAU, FRAUD, PROFILE, WARN_THRESHOLDS
from lendspark.functions.text import iso_date, valid_eid
from lendspark.operators.keyed import latest_per_key
from lendspark.operators.resolve import EVENT_IDS
from lendspark.operators.skew import small
from lendspark.session import cut
from lendspark.sources.files import read_table

MUST_PASS = "MUST_PASS"
WARN = "WARN"
ER = "er"
Tables = Mapping[str, DataFrame]

_SAMPLES = 3
_MAX_BUREAU_AGE_DAYS = 30
_ADULT_MONTHS = 18 * 12


class GateError(RuntimeError):
    """Promotion to gold is blocked."""

    def __init__(self, rule_ids: Sequence[str]):
        self.rule_ids = list(rule_ids)
        super().__init__(
            f"gold promotion blocked: {len(self.rule_ids)} MUST_PASS rule(s) breached: "
            + ", ".join(self.rule_ids)
        )


@dataclass(frozen=True)
class RowRule:
    rule_id: str
    severity: str
    source: str
    description: str
    failing: Callable[[datetime], Column]
    needs_rows: bool = False  # an empty table is itself a failure


@dataclass(frozen=True)
class TableRule:
    rule_id: str
    severity: str
    source: str
    description: str
    measure: Callable[[Tables], DataFrame]  # one row: checked, failed
    failures: Callable[[Tables], DataFrame]  # failing rows; the first column orders them


def threshold(rule: RowRule | TableRule) -> float:
    return 0.0 if rule.severity == MUST_PASS else WARN_THRESHOLDS.get(rule.rule_id, 0.0)


# --- predicates of the row rules ----------------------------------------------------------------


def _bad_eid(as_of: datetime) -> Column:
    return ~valid_eid(F.col("emirates_id"))


def _bad_score(as_of: datetime) -> Column:
    score = F.col("score").cast("string").try_cast("double")
    return ~F.coalesce(score.between(0, 1000), F.lit(False))


def _bad_status(as_of: datetime) -> Column:
    return ~F.coalesce(F.col("status").isin(*AML_STATUSES), F.lit(False))


def _implausible_dob(as_of: datetime) -> Column:
    latest = F.add_months(F.lit(as_of.date()), -_ADULT_MONTHS)
    plausible = iso_date(F.col("dob")).between(F.lit("1900-01-01").cast("date"), latest)
    return ~F.coalesce(plausible, F.lit(False))


def _stale_report(as_of: datetime) -> Column:
    oldest = F.date_sub(F.lit(as_of.date()), _MAX_BUREAU_AGE_DAYS)
    return ~F.coalesce(iso_date(F.col("report_date")) >= oldest, F.lit(False))


# --- measures of the table rules ----------------------------------------------------------------


def _customers_and_screening(tables: Tables) -> DataFrame:
    """Distinct profile customers with a flag for those never screened."""
    screened = tables[AML].select(F.col("emirates_id").alias("_eid")).distinct()
    customers = tables[PROFILE].select("emirates_id").distinct()
    return customers.join(screened, F.col("emirates_id").eqNullSafe(F.col("_eid")), "left_anti")


def _coverage(tables: Tables) -> DataFrame:
    customers = tables[PROFILE].select("emirates_id").distinct().withColumn("failed", F.lit(0))
    missing = _customers_and_screening(tables).select(F.lit(1).alias("failed"))
    both = customers.select(F.lit(1).alias("checked"), "failed").unionByName(
        missing.select(F.lit(0).alias("checked"), "failed")
    )
    return both.agg(F.sum("checked").alias("checked"), F.sum("failed").alias("failed"))


def _phone_pairs(tables: Tables) -> DataFrame:
    """Fraud phones beside the profile's, equal (customer, phone) rows collapsed before the join."""
    reported = (
        tables[FRAUD].where(F.col("emirates_id").isNotNull())
        .groupBy("emirates_id", F.col("phone").alias("fraud_phone"))
        .agg(F.count(F.lit(1)).alias("records"))
    )
    own = latest_per_key(tables[PROFILE], "emirates_id").select("emirates_id", F.col("phone").alias("profile_phone"))
    return reported.join(own, "emirates_id").withColumn(
        "differs", ~F.col("fraud_phone").eqNullSafe(F.col("profile_phone"))
    )


def _phone_conflicts(tables: Tables) -> DataFrame:
    return _phone_pairs(tables).agg(
        F.sum("records").alias("checked"), F.sum(F.when(F.col("differs"), F.col("records"))).alias("failed")
    )


def _quarantine_rate(tables: Tables) -> DataFrame:
    kept = tables["er_links"].agg(F.count(F.lit(1)).alias("checked")).withColumn("failed", F.lit(0).cast("bigint"))
    lost = tables["er_quarantine"].agg(F.count(F.lit(1)).alias("checked")).withColumn("failed", F.col("checked"))
    return kept.unionByName(lost).agg(F.sum("checked").alias("checked"), F.sum("failed").alias("failed"))


# rule ids, severities and descriptions are fixed values
RULES: tuple[RowRule | TableRule, ...] = (
    RowRule("eid_format", MUST_PASS, PROFILE,
            "Emirates ID must match 784-YYYY-NNNNNNN-C after normalisation.", _bad_eid),
    RowRule("fraud_score_range", MUST_PASS, FRAUD, "Fraud score must be in [0, 1000].", _bad_score),
    RowRule("aml_status_enum", MUST_PASS, AML, "AML status must be one of CLEAR, REVIEW, HIT.", _bad_status),
    RowRule("profile_dob_plausible", MUST_PASS, PROFILE,
            "DOB must be between 1900-01-01 and today − 18 years.", _implausible_dob),
    RowRule("aecb_freshness_30d", MUST_PASS, BUREAU,
            "Latest AECB report must be within 30 days.", _stale_report, needs_rows=True),
    TableRule("aml_coverage", WARN, AML,
              "At most 5% of profile customers may be missing an AML callback.",
              _coverage, _customers_and_screening),
    TableRule("fraud_phone_conflict", WARN, FRAUD,
              "Phone mismatch between fraud and profile should be rare.",
              _phone_conflicts,
              lambda t: _phone_pairs(t).where("differs").select("emirates_id", "profile_phone", "fraud_phone")),
    TableRule("er_quarantine_rate", WARN, ER,
              "At most 2% of records should land in entity resolution quarantine.",
              _quarantine_rate, lambda t: t["er_quarantine"].select("source_event_id", "source", "emirates_id")),
)


# --- scorecard ----------------------------------------------------------------------------------


def _describe(rule: RowRule | TableRule) -> list[Column]:
    return [
        F.lit(rule.rule_id).alias("rule_id"),
        F.lit(rule.severity).alias("severity"),
        F.lit(rule.source).alias("source"),
        F.lit(rule.description).alias("description"),
        F.lit(threshold(rule)).alias("threshold"),
        F.lit(isinstance(rule, RowRule) and rule.needs_rows).alias("needs_rows"),
    ]


def _measure_rows(table: DataFrame, rules: Sequence[RowRule], as_of: datetime) -> DataFrame:
    """(checked, failed) of every row rule on one table, from one aggregate over it."""
    failed = [F.count_if(rule.failing(as_of)).alias(rule.rule_id) for rule in rules]
    once = table.agg(F.count(F.lit(1)).alias("_checked"), *failed)
    lines = [
        F.struct(*_describe(rule), F.col("_checked").alias("checked"), F.col(rule.rule_id).alias("failed"))
        for rule in rules
    ]
    return once.select(F.inline(F.array(*lines)))


def scorecard(
    tables: Tables,
    as_of: datetime,
    run_id: str = "",
    rules: Sequence[RowRule | TableRule] = RULES,
) -> DataFrame:
    """One row per rule: checked, failed, ratio, threshold, breached, status and the first failing rows."""
    by_table: dict[str, list[RowRule]] = {}
    parts = []
    for rule in rules:
        if isinstance(rule, RowRule):
            by_table.setdefault(rule.source, []).append(rule)
        else:
            measured = rule.measure(tables)
            parts.append(measured.select(*_describe(rule), "checked", "failed"))
    parts += [_measure_rows(tables[source], group, as_of) for source, group in by_table.items()]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)

    checked = F.coalesce("checked", F.lit(0)).cast("bigint")
    empty = F.col("needs_rows") & (F.col("checked") == 0)
    ratio = F.when(F.col("checked") == 0, F.lit(0.0)).otherwise(F.col("failed") / F.col("checked"))
    scored = (
        union.withColumn("checked", checked)
        .withColumn("failed", F.when(empty, F.lit(1)).otherwise(F.coalesce("failed", F.lit(0))).cast("bigint"))
        .withColumn("breached", empty | (ratio > F.col("threshold")))
        .withColumn("fail_ratio", F.round(ratio, 4))
        .withColumn(
            "status",
            F.when(~F.col("breached"), "PASS").when(F.col("severity") == MUST_PASS, "FAIL").otherwise("WARN"),
        )
    )
    listed = samples(tables, as_of, rules).groupBy("rule_id").agg(
        F.array_sort(F.collect_list(F.struct("position", "sample"))).alias("_samples")
    )
    texts = F.transform(F.coalesce("_samples", F.array().cast("array<struct<position:int,sample:string>>")), lambda s: s["sample"])
    no_rows = F.concat(F.lit('{"reason":"no '), F.col("source"), F.lit(' data"}'))
    shown = F.when(empty, F.array(no_rows)).otherwise(texts)
    scored = scored.join(F.broadcast(listed), "rule_id", "left")  # a row per rule
    scored = scored.withColumn("sample_failures", F.concat(F.lit("["), F.array_join(shown, ","), F.lit("]"))).drop("needs_rows", "_samples")
    return scored.select(
        "rule_id", "severity", "source", "description", "checked", "failed", "fail_ratio", "threshold",
        "breached", "status", "sample_failures",
        F.lit(as_of).cast("timestamp").alias("evaluated_at"), F.lit(run_id).alias("run_id"),
    )


def _first_failing(failing: DataFrame, limit: int) -> DataFrame:
    """(rule_id, position, sample) of (rule_id, _key, _row): cut down in every map task, then put into JSON."""
    place = F.row_number().over(Window.partitionBy("rule_id").orderBy("_key", "_row"))
    first = failing.withColumn("position", place).where(F.col("position") <= limit)
    sample = F.to_json("_row", {"ignoreNullFields": "false"})
    return first.select("rule_id", (F.col("position") - 1).alias("position"), sample.alias("sample"))


def samples(
    tables: Tables,
    as_of: datetime,
    rules: Sequence[RowRule | TableRule] = RULES,
    limit: int = _SAMPLES,
) -> DataFrame:
    """The first few failing rows of each rule, by key: (rule_id, position, sample).

    All row rules of a table are looked at in one pass over it.
    """
    by_table: dict[str, list[RowRule]] = {}
    parts = []
    for rule in rules:
        if isinstance(rule, RowRule):
            by_table.setdefault(rule.source, []).append(rule)
        else:
            failing = rule.failures(tables)
            key = F.col(failing.columns[0]).cast("string").alias("_key")
            parts.append(_first_failing(failing.select(F.lit(rule.rule_id).alias("rule_id"), key, F.struct("*").alias("_row")), limit))
    for source, group in by_table.items():
        table = tables[source]
        key = EVENT_IDS[source] if EVENT_IDS[source] in table.columns else table.columns[0]
        shown = [key] + [c for c in table.columns if c not in (key, "raw_path", "position")]
        failed = F.array_compact(F.array(*[F.when(rule.failing(as_of), F.lit(rule.rule_id)) for rule in group]))
        failing = table.select(F.explode(failed).alias("rule_id"), F.col(key).cast("string").alias("_key"), F.struct(*shown).alias("_row"))
        parts.append(_first_failing(failing, limit))
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union


def persist(results: DataFrame, path: str) -> None:
    """Store results under (run_id, rule_id): a rule stored again replaces its own row of that run and no other.

    The rows of these runs that are not replaced are staged with the new ones, and the runs' partitions are then swapped;
    other runs are not touched. Of rows that share a key within `results` the last evaluated one counts.
    """
    spark = results.sparkSession
    key = ["run_id", "rule_id"]
    newest = Window.partitionBy(*key).orderBy(F.desc("evaluated_at"), F.desc("failed"))
    fresh = cut(results.withColumn("_place", F.row_number().over(newest)).where("_place = 1").drop("_place"))
    stored = read_table(spark, path, schemas.DQ_RESULT)
    kept = stored.join(small(fresh.select("run_id").distinct()), "run_id", "left_semi").join(small(fresh.select(*key)), key, "left_anti")
    staged = cut(fresh.select(*stored.columns).unionByName(kept))
    staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path)


def verdict(results: DataFrame) -> DataFrame:
    """One row: whether gold may be promoted, and the MUST_PASS rules that forbid it."""
    breached = F.col("breached") & (F.col("severity") == MUST_PASS)
    ids = F.array_sort(F.collect_list(F.when(breached, F.col("rule_id"))))
    return results.agg(
        (F.count_if(breached) == 0).alias("promoted"),
        F.count_if(breached).alias("must_pass_breaches"),
        F.count_if(F.col("breached") & (F.col("severity") == WARN)).alias("warn_breaches"),
        F.array_join(ids, ", ").alias("rule_ids"),
    )


def gate(results: DataFrame) -> None:
    """Raise `GateError` if any MUST_PASS rule is breached. Reads one row per rule."""
    found = results.where(F.col("breached") & (F.col("severity") == MUST_PASS)).select("rule_id").collect()
    if found:
        raise GateError(sorted(row["rule_id"] for row in found))

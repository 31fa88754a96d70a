"""Typed tables from raw documents: bureau XML, fraud and AML JSON, profile tables.

Each parser returns `Parsed`: the rows that satisfy the declared types and enums, and the rejects with
their reason. With `strict=True` the first reject fails the job instead.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendspark import schemas
from lendspark.config import AML, AML_STATUSES, BUREAU, FRAUD, FRAUD_DECISIONS, PROFILE
from lendspark.functions import nested
from lendspark.functions.text import (
    birth_date_to_iso,
    element_text,
    first_filled,
    int_or_null,
    normalise_eid,
    strip,
)
from lendspark.session import cut

_XML_OPTIONS = {
    "mode": "PERMISSIVE",
    "ignoreNamespace": "true",
    "ignoreSurroundingSpaces": "false",
    "columnNameOfCorruptRecord": "_corrupt_record",
}
_BAD_LATE = ("OVERDUE", "PAID_LATE")


_USER_FIELDS = (
    "internal_uuid", "emirates_id", "first_name", "last_name", "full_name", "dob", "phone", "email",
    "emirate", "kyc_verified_at",
)


class Parsed(NamedTuple):
    """Parsed records with their verdict: `_reason` is NULL where a record is good, `_raw` what was delivered."""

    marked: DataFrame
    source: str
    also: tuple[str, ...] = ()  # further columns of the rejects

    @property
    def rows(self) -> DataFrame:
        return self.marked.where(F.col("_reason").isNull()).drop("_reason", "_raw", *self.also)

    @property
    def rejects(self) -> DataFrame:
        bad = self.marked.where(F.col("_reason").isNotNull())
        return bad.select(
            F.lit(self.source).alias("source"), F.col("_reason").alias("reason"), F.col("_raw").alias("raw"), "raw_path", *self.also
        )

    def stored(self) -> Parsed:
        """The same records, parsed and stored once, however often rows and rejects are read."""
        return self._replace(marked=cut(self.marked))


def _origin() -> list[Column]:
    return [
        F.col("raw_path"),
        F.struct(F.lit(0).cast("bigint").alias("block"), F.lit(0).cast("bigint").alias("row")).alias("position"),
    ]


Check = tuple[Column, str]  # what must hold, and the reason given where it does not


def _present(*names: str) -> list[Check]:
    return [(F.col(n).isNotNull(), f"{n} missing") for n in names]


def _allowed(name: str, values: tuple[str, ...]) -> Check:
    return F.coalesce(F.col(name).isin(*values), F.lit(False)), f"{name} not allowed"


def _checked(typed: DataFrame, source: str, checks: list[Check], strict: bool) -> Parsed:
    """Give every record its verdict; `typed` carries the delivered record as `item`."""
    ok = reduce(and_, [holds for holds, _ in checks])
    reasons = F.concat_ws("; ", *[F.when(~holds, F.lit(reason)) for holds, reason in checks])
    if strict:
        reasons = F.raise_error(F.concat(F.lit(f"{source} record rejected: "), reasons)).cast("string")
    raw = F.to_json("item", {"ignoreNullFields": "false"})
    marked = typed.withColumns({"_reason": F.when(~ok, reasons), "_raw": F.when(~ok, raw)})
    return Parsed(marked.drop("item"), source)


def json_items(bronze: DataFrame, item_schema: str) -> DataFrame:
    """The items of JSON-array documents held in bronze rows, with their origin.

    A document that is no JSON array yields one NULL item, which the parsers reject.
    """
    item_type = f"struct<{item_schema}>"
    items = F.from_json(F.decode("content", "UTF-8"), f"array<{item_type}>")
    items = F.coalesce(items, F.array(F.lit(None).cast(item_type)))
    return bronze.select(
        "raw_path", "ingest_run_id", F.posexplode(items).alias("_pos", "item")
    ).select(
        "item",
        "raw_path",
        "ingest_run_id",
        F.struct(F.lit(0).cast("bigint").alias("block"), F.col("_pos").cast("bigint").alias("row")).alias(
            "position"
        ),
    )


def line_items(records: DataFrame, item_schema: str) -> DataFrame:
    """The items of line-delimited records, with their origin; a line that is no object yields a NULL item."""
    item = F.from_json("line", item_schema)
    whole = F.when(F.get_json_object("line", "$").startswith("{"), item)
    return records.select(whole.alias("item"), "raw_path", "ingest_run_id", "position")


def _whole_number(c: Column) -> Column:
    """INT from JSON text; a fraction of zero is allowed, any other is not."""
    return F.coalesce(int_or_null(c), int_or_null(F.regexp_extract(c, r"^\s*([+-]?[0-9]+)\.0+\s*$", 1)))


def parse_fraud(items: DataFrame, strict: bool = False) -> Parsed:
    """Fraud scores from `items` (item, raw_path, position, ingest_run_id)."""
    item = F.col("item")
    typed = items.select(
        "item",
        item["provider_ref"].alias("provider_ref"),
        normalise_eid(item["emirates_id"]).alias("emirates_id"),
        item["phone"].alias("phone"),
        F.lower(item["email"]).alias("email"),
        _whole_number(item["score"]).alias("score"),
        item["decision"].alias("decision"),
        F.coalesce(item["reason_codes"], F.array().cast("array<string>")).alias("reason_codes"),
        item["model_version"].alias("model_version"),
        item["scored_at"].try_cast("timestamp").alias("scored_at"),
        "ingest_run_id",
        "raw_path",
        "position",
    )
    checks = _present("provider_ref", "phone", "email", "score", "model_version", "scored_at")
    checks.append(_allowed("decision", FRAUD_DECISIONS))
    return _checked(typed, FRAUD, checks, strict)


def parse_aml(items: DataFrame, strict: bool = False) -> Parsed:
    """AML screenings from `items` (item, raw_path, position, ingest_run_id)."""
    item = F.col("item")
    typed = items.select(
        "item",
        item["callback_id"].alias("callback_id"),
        normalise_eid(item["emirates_id"]).alias("emirates_id"),
        item["full_name"].alias("full_name"),
        item["dob"].alias("dob"),
        item["status"].alias("status"),
        F.coalesce(item["matched_lists"], F.array().cast("array<string>")).alias("matched_lists"),
        item["received_at"].try_cast("timestamp").alias("received_at"),
        "ingest_run_id",
        "raw_path",
        "position",
    )
    checks = _present("callback_id", "full_name", "dob", "received_at")
    checks.append(_allowed("status", AML_STATUSES))
    return _checked(typed, AML, checks, strict)


def behavioural_features(users: DataFrame, applications: DataFrame, instalments: DataFrame) -> DataFrame:
    """Users with `is_new_user` and `had_overdue_before`.

    Late instalments shrink to one row per application before they meet the applications, and both
    features come out of one aggregate per user.
    """
    late = (
        instalments.where(F.col("status").isin(*_BAD_LATE)).select("application_id").distinct()
        .withColumn("_late", F.lit(True))
    )
    history = (
        applications.where(F.col("internal_uuid").isNotNull())
        .select("application_id", "internal_uuid")
        .join(late, "application_id", "left")
        .groupBy("internal_uuid")
        .agg(F.max(F.coalesce("_late", F.lit(False))).alias("_any_late"))
    )
    return (
        users.join(history, "internal_uuid", "left")
        .withColumn("is_new_user", F.col("_any_late").isNull())
        .withColumn("had_overdue_before", F.coalesce("_any_late", F.lit(False)))
        .drop("_any_late")
    )


def parse_profile(
    users: DataFrame, applications: DataFrame, instalments: DataFrame, run_id: str, strict: bool = False
) -> Parsed:
    """Customer profiles with behavioural features; `users` may carry raw_path and position."""
    if "position" not in users.columns:
        users = users.withColumn(
            "position",
            F.struct(F.lit(0).cast("bigint").alias("block"), F.monotonically_increasing_id().alias("row")),
        )
    if "raw_path" not in users.columns:
        users = users.withColumn("raw_path", F.lit(PROFILE))
    featured = behavioural_features(users, applications, instalments)
    typed = featured.select(
        F.struct(*_USER_FIELDS).alias("item"),
        "internal_uuid",
        normalise_eid(F.col("emirates_id")).alias("emirates_id"),
        "first_name",
        "last_name",
        "full_name",
        "dob",
        "phone",
        F.lower("email").alias("email"),
        "emirate",
        F.col("kyc_verified_at").try_cast("timestamp").alias("kyc_verified_at"),
        "is_new_user",
        "had_overdue_before",
        F.lit(run_id).alias("ingest_run_id"),
        "raw_path",
        "position",
    )
    checks = _present(*_USER_FIELDS)
    return _checked(typed, PROFILE, checks, strict)


def bureau_documents(bronze: DataFrame) -> DataFrame:
    """Bureau documents parsed into a nested struct; malformed text keeps `_corrupt_record`.

    The one-element explode keeps the optimizer from copying the XML parse into every filter that
    looks at its result: each document is parsed once.
    """
    document = F.from_xml(F.decode("content", "UTF-8"), schemas.BUREAU_DOCUMENT, _XML_OPTIONS)
    return bronze.select(
        "source_event_id", "raw_path", "ingest_run_id", F.explode(F.array(document)).alias("doc")
    )


def parse_bureau(bronze: DataFrame, as_of: datetime) -> Parsed:
    """Bureau reports flattened to one row each; documents without a report body are rejected."""
    documents = bureau_documents(bronze)
    report = F.col("doc")["Body"]["MGResponse"]["MGResponse"]["NAE_RES"]
    reason = F.when(F.col("doc")["_corrupt_record"].isNotNull(), F.lit("malformed XML")).when(
        report.isNull(), F.lit("no report body")
    )
    stamp = F.col("doc")["Header"]["MessageResponse"]["_MTs"]
    reports = documents.select(
        "raw_path", "ingest_run_id", "source_event_id", reason.alias("_reason"),
        F.col("doc")["_corrupt_record"].alias("_raw"), F.nullif(stamp, F.lit("")).alias("stamp"), report.alias("r"),
    )
    r = F.col("r")
    enquired = r["EnquiredSubject"]["Individual"]
    matched = r["Response"]["MatchedSubject"]["Individual"]
    score = r["Response"]["Score"]
    both = lambda name: first_filled(element_text(enquired[name]), element_text(matched[name]))
    spelled = F.concat(
        F.coalesce(element_text(enquired["NameEN"]["FirstName"]), F.lit("")),
        F.lit(" "),
        F.coalesce(element_text(enquired["NameEN"]["LastName"]), F.lit("")),
    )
    marked = reports.select(
        F.coalesce(
            first_filled(element_text(r["NewApplication"]["CBContractId"]), element_text(r["ResponseId"])),
            F.lit("unknown"),
        ).alias("report_id"),
        element_text(r["Response"]["MatchedSubject"]["CBSubjectId"]).alias("cb_subject_id"),
        F.coalesce(F.substring("stamp", 1, 10), F.lit(as_of.date().isoformat())).alias("report_date"),
        normalise_eid(both("EmiratesId")).alias("emirates_id"),
        F.coalesce(F.nullif(element_text(matched["FullNameEN"]), F.lit("")), strip(spelled)).alias("full_name"),
        birth_date_to_iso(both("DOB")).alias("dob"),
        both("Nationality").alias("nationality"),
        int_or_null(element_text(score["Data"]["Index"])).alias("credit_score"),
        element_text(score["Data"]["Range"]).alias("score_range"),
        F.coalesce(F.upper(element_text(score["PaymentOrderFlag"])) == "Y", F.lit(False)).alias(
            "payment_order_flag"
        ),
        nested.bounced_cheque_count(r["Response"]["PaymentOrder"]).alias("num_bounced_cheques"),
        nested.bounced_cheque_total(r["Response"]["PaymentOrder"]).alias("total_bounced_cheques_amount"),
        nested.case_count(r["Response"]["Cases"]).alias("num_court_cases"),
        nested.open_case_count(r["Response"]["Cases"]).alias("num_open_court_cases"),
        nested.claim_total(r["Response"]["Cases"]).alias("total_claim_amount"),
        nested.latest_income(r["Response"]["EmploymentHistory"]).alias("gross_annual_income"),
        "ingest_run_id",
        *_origin(),
        "_reason",
        "_raw",
        "source_event_id",
    )
    return Parsed(marked, BUREAU, ("source_event_id",))


def record_counts(silver: dict[str, DataFrame]) -> DataFrame:
    """Rows of each silver table, by source."""
    counts = [
        df.select(F.lit(source).alias("source")).groupBy("source").agg(F.count(F.lit(1)).alias("records"))
        for source, df in silver.items()
    ]
    total = counts[0]
    for one in counts[1:]:
        total = total.unionByName(one)
    return total

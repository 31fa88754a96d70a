"""Conflict log: where sources disagree on a customer's field, and which one wins."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendspark.config import AML, BUREAU, FRAUD, PROFILE
from lendspark.functions.text import compare_form
from lendspark.operators.keyed import first_per_key

# The sources of each field, the most trusted first.
PRECEDENCE = {
    "phone": (PROFILE, FRAUD),
    "email": (PROFILE, FRAUD),
    "full_name": (PROFILE, BUREAU, AML),
    "dob": (PROFILE, BUREAU, AML),
}


def detect_conflicts(silver: Mapping[str, DataFrame], logged_at: datetime) -> DataFrame:
    """One row per profile customer, field and source that differs from the winning source.

    Each source is cut down to its first record per customer and to the compared fields; then one
    join per source on the same key brings them side by side, and the comparison is row-local.
    """
    wide = None
    for source in (PROFILE, BUREAU, FRAUD, AML):
        fields = [f for f, order in PRECEDENCE.items() if source in order]
        one = first_per_key(silver[source].select("emirates_id", *fields, "raw_path", "position"), "emirates_id")
        one = one.select("emirates_id", *[F.col(f).alias(f"{source}_{f}") for f in fields])
        wide = one if wide is None else wide.join(one, "emirates_id", "left")

    entries = []
    for field, order in PRECEDENCE.items():
        claims = F.filter(
            F.array(
                *[
                    F.struct(
                        F.lit(source).alias("source"),
                        F.col(f"{source}_{field}").alias("value"),
                        compare_form(field, F.col(f"{source}_{field}")).alias("form"),
                    )
                    for source in order
                ]
            ),
            lambda c: F.coalesce(c["value"], F.lit("")) != "",
        )
        winner = F.get(claims, F.lit(0))
        losers = F.filter(claims, lambda c: c["form"] != winner["form"])
        entries.append(
            F.transform(
                losers,
                lambda c: F.struct(
                    F.lit(field).alias("field"),
                    winner["source"].alias("winning_source"),
                    winner["value"].alias("winning_value"),
                    c["source"].alias("losing_source"),
                    c["value"].alias("losing_value"),
                ),
            )
        )
    return wide.select("emirates_id", F.inline(F.concat(*entries))).withColumn(
        "logged_at", F.lit(logged_at).cast("timestamp")
    )

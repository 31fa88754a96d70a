"""Entity resolution: tie every source record to one customer, in four tiers.

1. a valid Emirates ID known to the profiles (profile and bureau records may also introduce one);
2. phone and e-mail of one profile; 3. one profile with the same birth date and a similar name;
4. quarantine. Only what a tier leaves over goes on to the next.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendspark.config import AML, BUREAU, FRAUD, NAME_FUZZY_THRESHOLD, PROFILE
from lendspark.functions.similarity import (
    jaro_winkler_column,
    may_reach,
    meets,
    with_index_keys,
    with_letter_bits,
    with_probe_keys,
)
from lendspark.functions.text import valid_eid
from lendspark.operators.keyed import latest_per_key
from lendspark.operators.skew import lookup, small
from lendspark.session import cut

EVENT_IDS = {
    PROFILE: "internal_uuid",
    BUREAU: "report_id",
    FRAUD: "provider_ref",
    AML: "callback_id",
}
EID_EXACT = "eid_exact"
PHONE_EMAIL_EXACT = "phone_email_exact"
NAME_DOB_FUZZY = "name_dob_fuzzy"
QUARANTINE = "quarantine"

# Known names of one birth date that are compared without keys. A name has some two hundred keys, each of which is
# shuffled, sorted and joined; comparing the letter bits of two names takes well under a thousandth of that.
DIRECT_NAMES = 5_000
# Comparisons of one date that one task is given; more are dealt out.
DIRECT_PAIRS = 4_000_000

# Notes stored with each link.
NOTE_NEW = "new customer (EID not yet in profile index)"
NOTE_BACKFILLED = "backfilled emirates_id from profile"
NOTE_FUZZY = "jaro-winkler=%.3f, backfilled emirates_id"
NOTE_QUARANTINE = "no match in any tier"

_MAY_INTRODUCE = (PROFILE, BUREAU)
_INPUT_COLUMNS = ("emirates_id", "phone", "email", "full_name", "dob")


def resolver_inputs(silver: Mapping[str, DataFrame]) -> DataFrame:
    """The silver tables as one stream of records with the fields the tiers look at."""
    stream = None
    for source, event_id in EVENT_IDS.items():
        if source not in silver:
            continue
        df = silver[source]
        fields = [
            F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in _INPUT_COLUMNS
        ]
        rows = df.select(
            F.lit(source).alias("source"),
            F.col(event_id).alias("source_event_id"),
            *fields,
            "raw_path",
            "position",
        )
        stream = rows if stream is None else stream.unionByName(rows)
    return stream


def _filled(*names: str) -> Column:
    ok = F.lit(True)
    for name in names:
        ok = ok & (F.coalesce(F.col(name), F.lit("")) != "")
    return ok


def _outcome(tier: str | None, eid: Column, confidence: Column, note: Column) -> list[Column]:
    return [
        F.lit(tier).cast("string").alias("match_tier"),
        eid.alias("resolved_eid"),
        confidence.cast("double").alias("confidence"),
        note.cast("string").alias("notes"),
    ]


def match_emirates_id(records: DataFrame, profiles: DataFrame) -> DataFrame:
    """Tier 1. Adds match_tier (NULL if the record goes on), resolved_eid, confidence and notes.

    A profile's own ID is by definition known, so profile records skip the lookup, and records
    without a valid ID skip it too instead of piling up under one NULL key.
    """
    looked_up = valid_eid(F.col("emirates_id")) & (F.col("source") != PROFILE)
    known = profiles.select(F.col("emirates_id")).where(valid_eid(F.col("emirates_id"))).distinct()
    hits = (
        lookup(records.where(looked_up), known.withColumn("_known", F.lit(True)), ["emirates_id"], "left")
        .withColumn("_known", F.coalesce("_known", F.lit(False)))
    )
    others = records.where(~looked_up).withColumn("_known", valid_eid(F.col("emirates_id")))
    matched = F.col("_known") | (valid_eid(F.col("emirates_id")) & F.col("source").isin(*_MAY_INTRODUCE))
    return (
        hits.unionByName(others)
        .withColumn("match_tier", F.when(matched, F.lit(EID_EXACT)))
        .withColumn("resolved_eid", F.when(matched, F.col("emirates_id")))
        .withColumn("confidence", F.when(matched, F.lit(1.0)))
        .withColumn("notes", F.when(matched & ~F.col("_known"), F.lit(NOTE_NEW)))
        .drop("_known")
    )


def match_phone_email(records: DataFrame, profiles: DataFrame) -> DataFrame:
    """Tier 2: records with the phone and e-mail of a profile, tied to the last such profile."""
    index = latest_per_key(profiles.withColumn("_mail", F.lower("email")), "phone", "_mail").select(
        "phone", "_mail", F.col("emirates_id").alias("_eid")
    )
    eligible = records.where(_filled("phone", "email")).withColumn("_mail", F.lower("email"))
    return lookup(eligible, index, ["phone", "_mail"]).select(
        *records.columns, *_outcome(PHONE_EMAIL_EXACT, F.col("_eid"), F.lit(0.95), F.lit(NOTE_BACKFILLED))
    )


def _distinct_names(df: DataFrame) -> DataFrame:
    return df.where(_filled("full_name", "dob")).select("dob", F.lower("full_name").alias("name"))


def _spread(names: DataFrame, *by: str) -> DataFrame:
    """Names over all tasks: the rows are small, but each is about to become a hundred keys."""
    parts = int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return names.repartition(parts, F.xxhash64(*by))


def strong_name_pairs(wanted: DataFrame, known: DataFrame, floor: float = NAME_FUZZY_THRESHOLD) -> DataFrame:
    """Pairs of distinct (dob, name) with similarity of at least `floor`: all of them, once.

    `wanted` and `known` hold distinct non-empty (dob, name); `known` may carry further columns.
    On a date with up to DIRECT_NAMES known names, all of these are candidates, and the names asked for are dealt into
    parts of like size. On other dates names meet through blocking keys, never by the date alone: one that holds
    a third of all customers would otherwise pair every name with every other. Only dates that are asked for are looked
    at, and a pair that meets under several keys is scored once. Both sides are stored with their letter bits, which
    would otherwise be worked out again for every filter on them, by the few tasks that read the names.
    """
    asked_names = wanted.groupBy("dob").agg(F.count(F.lit(1)).alias("_asked"))
    dates = known.groupBy("dob").agg(F.count(F.lit(1)).alias("_names")).join(asked_names, "dob")
    parts = F.ceil(F.col("_names") * F.col("_asked") / DIRECT_PAIRS)
    dates = small(dates.select("dob", "_names", parts.alias("_parts")))
    listed = with_letter_bits(
        _spread(known.withColumnRenamed("name", "known_name"), "dob", "known_name").join(dates, "dob"), "known_name", "_known_bits"
    )
    asked = with_letter_bits(_spread(wanted, "dob", "name").join(dates, "dob"), "name", "_bits")
    listed, asked = cut(listed), cut(asked)
    few = F.col("_names") <= DIRECT_NAMES
    likely = may_reach("name", "known_name", "_bits", "_known_bits", floor)
    index = with_index_keys(listed.where(~few).drop("_names", "_parts"), "dob", "known_name", floor)
    probes = with_probe_keys(asked.where(~few).drop("_names", "_parts"), "dob", "name", floor)
    by_key = (
        probes.join(index, ["key", "dob", "prefix"])
        .where(meets("name", "known_name", "prefix") & likely)
        .drop("key", "prefix")
        .dropDuplicates(["dob", "name", "known_name"])
    )
    # Spread again: the few small files that it was stored in would be read by fewer tasks than there are cores.
    dealt = _spread(asked.where(few), "dob", "name").withColumn("_part", F.pmod(F.xxhash64("name"), "_parts")).drop("_names", "_parts")
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_parts") - 1))
    offered = listed.where(few).withColumn("_part", every).drop("_names", "_parts")
    direct = dealt.join(offered, ["dob", "_part"]).where(likely).drop("_part")
    return (
        by_key.unionByName(direct)
        .drop("_bits", "_known_bits")
        .withColumn("score", jaro_winkler_column("name", "known_name"))
        .where(F.col("score") >= floor)
    )


def match_name_dob(records: DataFrame, profiles: DataFrame, floor: float = NAME_FUZZY_THRESHOLD) -> DataFrame:
    """Tier 3: records for which exactly one profile of the same birth date has a similar name.

    Equal names are collapsed on both sides before any comparison. A name that several profiles
    share exactly is ambiguous at once; for the others the smallest and the largest similar name
    tell "one" from "several" without ever gathering them.
    """
    known = (
        profiles.where(_filled("full_name", "dob"))
        .select("dob", F.lower("full_name").alias("name"), "emirates_id")
        .groupBy("dob", "name")
        .agg(F.count(F.lit(1)).alias("profiles"), F.max("emirates_id").alias("eid"))
    )
    shared = known.where(F.col("profiles") > 1).select("dob", "name")
    wanted = _distinct_names(records).distinct().join(shared, ["dob", "name"], "left_anti")
    entry = F.struct("known_name", "profiles", "eid", "score")
    single = (
        strong_name_pairs(wanted, known, floor)
        .groupBy("dob", "name")
        .agg(F.min(entry).alias("lo"), F.max(entry).alias("hi"))
        .where((F.col("lo.known_name") == F.col("hi.known_name")) & (F.col("lo.profiles") == 1))
        .select("dob", F.col("name").alias("_name"), F.col("lo.eid").alias("_eid"), F.col("lo.score").alias("_score"))
    )
    eligible = records.where(_filled("full_name", "dob")).withColumn("_name", F.lower("full_name"))
    return lookup(eligible, single, ["dob", "_name"]).select(
        *records.columns,
        *_outcome(
            NAME_DOB_FUZZY,
            F.col("_eid"),
            F.round("_score", 3),
            F.format_string(NOTE_FUZZY, F.col("_score")),
        ),
    )


_ROW = ["source", "raw_path", "position"]


def _left_over(records: DataFrame, matched: DataFrame) -> DataFrame:
    return records.join(matched.select(*_ROW), _ROW, "left_anti")


def resolve(silver: Mapping[str, DataFrame], floor: float = NAME_FUZZY_THRESHOLD) -> DataFrame:
    """Every record of the silver tables with its tier, Emirates ID, confidence and notes.

    Each tier's result is stored once: the next tier then starts from the few records left over
    instead of repeating the joins before it.
    """
    profiles = silver[PROFILE]
    first = cut(match_emirates_id(resolver_inputs(silver), profiles))
    outcome = ["match_tier", "resolved_eid", "confidence", "notes"]
    rest = first.where(F.col("match_tier").isNull()).drop(*outcome)
    by_contact = cut(match_phone_email(rest, profiles))
    rest = cut(_left_over(rest, by_contact))
    by_name = cut(match_name_dob(rest, profiles, floor))
    failed = _left_over(rest, by_name).select(
        "*",
        *_outcome(
            QUARANTINE, F.coalesce("emirates_id", F.lit("")), F.lit(0.0), F.lit(NOTE_QUARANTINE)
        ),
    )
    return (
        first.where(F.col("match_tier").isNotNull())
        .unionByName(by_contact)
        .unionByName(by_name)
        .unionByName(failed)
    )


def _link_columns(resolved_at: datetime) -> list[Column]:
    return [
        F.col("source"),
        F.col("source_event_id"),
        F.col("resolved_eid").alias("emirates_id"),
        F.col("match_tier"),
        F.col("confidence"),
        F.lit(resolved_at).cast("timestamp").alias("resolved_at"),
        F.col("notes"),
    ]


def links(resolved: DataFrame, resolved_at: datetime) -> DataFrame:
    """Resolved records; profile records count as resolved whatever their tier."""
    kept = (F.col("match_tier") != QUARANTINE) | (F.col("source") == PROFILE)
    return resolved.where(kept).select(*_link_columns(resolved_at))


def quarantine(resolved: DataFrame, silver: Mapping[str, DataFrame], resolved_at: datetime) -> DataFrame:
    """Unresolved records with the whole source record as JSON.

    Only the few unresolved rows go back to their source table for it.
    """
    failed = resolved.where((F.col("match_tier") == QUARANTINE) & (F.col("source") != PROFILE))
    failed = failed.select(*_link_columns(resolved_at), "raw_path", "position")
    out = None
    for source in (BUREAU, FRAUD, AML):
        if source not in silver:
            continue
        table = silver[source]
        body = [c for c in table.columns if c not in ("raw_path", "position")]
        whole = table.select(
            "raw_path", "position", F.to_json(F.struct(*body), {"ignoreNullFields": "false"}).alias("source_record")
        )
        rows = failed.where(F.col("source") == source).join(whole, ["raw_path", "position"])
        out = rows if out is None else out.unionByName(rows)
    return out.drop("raw_path", "position")


def summary(resolved: DataFrame) -> DataFrame:
    """Records by tier."""
    return resolved.groupBy("match_tier").agg(F.count(F.lit(1)).alias("records"))


def backfill(table: DataFrame, resolved: DataFrame, source: str) -> DataFrame:
    """A silver table with the resolved Emirates ID in place of its own; unresolved rows keep theirs."""
    found = resolved.where((F.col("source") == source) & (F.col("match_tier") != QUARANTINE)).select(
        "raw_path", "position", "resolved_eid"
    )
    return (
        table.join(found, ["raw_path", "position"], "left")
        .withColumn("emirates_id", F.coalesce("resolved_eid", "emirates_id"))
        .drop("resolved_eid")
    )

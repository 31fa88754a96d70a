"""One query per operator, each over whole tables: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendspark import schemas
from lendspark.catalog.feeds import AS_OF, RUN_ID, Feeds
from lendspark.config import AML, BUREAU, FRAUD, PROFILE
from lendspark.functions import canonical, text
from lendspark.operators import (
    audit,
    bronze,
    conflicts,
    content_store,
    decisions,
    keyed,
    merkle,
    packs,
    quality,
    reports,
    resolve,
    silver,
    vectors,
)
from lendspark.plans import pipeline
from lendspark.session import configure, cut, scratch_path
from lendspark.sources.files import read_table, write_table
from lendspark.streaming import landing

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Callable[[Feeds], DataFrame]) -> Callable[[Feeds], DataFrame]:
    """Register a query under its function's name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(Feeds(configure(spark), sf_dir))

    QUERIES[build.__name__] = run
    return build


def _text_list(name: str) -> Column:
    return F.array_join(name, ",").alias(name)


def _stamp(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)


# --- steps shared by several queries ---


def _stored_silver(f: Feeds, dirty_bureau: bool = False) -> dict[str, DataFrame]:
    tables = f.silver()
    if dirty_bureau:
        tables[BUREAU] = f.bureau(dirty=True)
    return {source: cut(df) for source, df in tables.items()}


def _decided(f: Feeds) -> DataFrame:
    return decisions.decide(vectors.assemble(f.silver(), AS_OF), AS_OF, RUN_ID)


def _facts(f: Feeds) -> DataFrame:
    return decisions.fact_decision(_decided(f))


def _quality_tables(f: Feeds) -> dict[str, DataFrame]:
    tables = _stored_silver(f, dirty_bureau=True)
    resolved = cut(resolve.resolve(tables))
    tables["er_links"] = resolve.links(resolved, AS_OF)
    tables["er_quarantine"] = resolve.quarantine(resolved, tables, AS_OF)
    return tables


def _results(f: Feeds) -> DataFrame:
    return cut(quality.scorecard(_quality_tables(f), AS_OF, RUN_ID))


def _customer_number(eid: str = "emirates_id") -> Column:
    return F.substring(eid, 10, 7).try_cast("bigint") - 1000000


def _audit(f: Feeds) -> dict[str, DataFrame]:
    decided = cut(_decided(f))
    snapshots = cut(audit.write_snapshots(decided))
    return {
        "index": audit.snapshot_index(snapshots),
        "bodies": audit.snapshot_bodies(snapshots),
        "vectors": audit.vector_store_rows(audit.hashed_vectors(decided)),
    }


def _tampered(f: Feeds) -> dict[str, DataFrame]:
    """Stored chains after someone changed outcomes, removed bodies and edited vectors."""
    stored = _audit(f)
    k = _customer_number() % 100
    bodies = stored["bodies"].where(k != 13)
    flipped = F.when(F.col("outcome") == "REFER", F.lit("APPROVE")).otherwise(F.lit("REFER"))
    bodies = bodies.withColumn("outcome", F.when(k == 7, flipped).otherwise(F.col("outcome")))
    of_vector = _customer_number_in_json()
    edited = F.regexp_replace("json", '"credit_score":', '"credit_score":9')
    altered = stored["vectors"].withColumn("json", F.when(of_vector % 100 == 21, edited).otherwise(F.col("json")))
    return {"index": stored["index"], "bodies": bodies, "vectors": altered}


def _customer_number_in_json() -> Column:
    return F.substring(F.get_json_object("json", "$.emirates_id"), 10, 7).try_cast("bigint") - 1000000


# --- sources and raw zone ---


@query
def bronze_land(f: Feeds) -> DataFrame:
    return f.batch().select(
        "source", "source_event_id", "content_sha256", "raw_path", "payload_format", "ingest_run_id",
        "ingest_date", _stamp("received_at"),
    )


@query
def bronze_summary(f: Feeds) -> DataFrame:
    return bronze.summary(f.batch())


@query
def bronze_idempotent(f: Feeds) -> DataFrame:
    store = scratch_path(f.spark, "bronze")
    batch = cut(f.batch())
    day = AS_OF.date().isoformat()
    bronze.append_new(batch, store, day)
    return bronze.summary(bronze.append_new(batch, store, day))


@query
def bronze_incremental(f: Feeds) -> DataFrame:
    """Two deliveries and three runs of the landing stream: what each run read, by source and content."""
    folder, store = scratch_path(f.spark, "landing"), scratch_path(f.spark, "bronze")
    patterns = {source: "*.txt" for source in (BUREAU, FRAUD, AML)}
    for run, part in (("first", "k % 3 <> 0"), ("second", "k % 3 = 0"), ("third", None)):
        if part:
            f.deliver(folder, part)
        landing.land_files(f.spark, folder, store, run, AS_OF, patterns=patterns, files_per_batch=500)
    landed = landing.read_landed(f.spark, store)
    return landed.groupBy("source", "ingest_run_id", "content_sha256").agg(F.count("*").alias("files"))


@query
def parse_bureau_xml(f: Feeds) -> DataFrame:
    rows = silver.parse_bureau(f.landed(BUREAU, f.bureau_files()), AS_OF).rows
    return rows.drop("raw_path", "position", "ingest_run_id")


@query
def bureau_rejects(f: Feeds) -> DataFrame:
    rejects = silver.parse_bureau(f.landed(BUREAU, f.bureau_files()), AS_OF).rejects
    return rejects.select("source", "source_event_id", "reason")


def _fraud_shown(rows: DataFrame) -> DataFrame:
    return rows.select(
        "provider_ref", "emirates_id", "phone", "email", "score", "decision", _text_list("reason_codes"), "model_version", _stamp("scored_at")
    )


def _aml_shown(rows: DataFrame) -> DataFrame:
    return rows.select("callback_id", "emirates_id", "full_name", "dob", "status", _text_list("matched_lists"), _stamp("received_at"))


@query
def parse_fraud(f: Feeds) -> DataFrame:
    items = silver.line_items(f.record_files("fraud_items", "item", FRAUD), schemas.FRAUD_ITEM)
    return _fraud_shown(silver.parse_fraud(items, strict=True).rows)


@query
def parse_aml(f: Feeds) -> DataFrame:
    items = silver.line_items(f.record_files("aml_items", "item", AML), schemas.AML_ITEM)
    return _aml_shown(silver.parse_aml(items, strict=True).rows)


@query
def parse_fraud_array(f: Feeds) -> DataFrame:
    items = silver.line_items(f.array_files("fraud_items", "item", FRAUD), schemas.FRAUD_ITEM)
    return _fraud_shown(silver.parse_fraud(items, strict=True).rows)


@query
def parse_aml_array(f: Feeds) -> DataFrame:
    items = silver.line_items(f.array_files("aml_items", "item", AML), schemas.AML_ITEM)
    return _aml_shown(silver.parse_aml(items, strict=True).rows)


@query
def validate_split(f: Feeds) -> DataFrame:
    items = silver.line_items(f.record_files("fraud_items", "dirty_item", FRAUD), schemas.FRAUD_ITEM)
    parsed = silver.parse_fraud(items).stored()
    good = parsed.rows.select("provider_ref", F.lit("valid").alias("verdict"))
    bad = parsed.rejects.select(
        F.get_json_object("raw", "$.provider_ref").alias("provider_ref"), F.col("reason").alias("verdict")
    )
    return good.unionByName(bad)


@query
def silver_overwrite(f: Feeds) -> DataFrame:
    """A whole table written over: nothing of the first delivery is left."""
    store = scratch_path(f.spark, "silver")
    dirty, clean = f.bureau(dirty=True).where("credit_score >= 600"), f.bureau().where("credit_score < 600")
    write_table(dirty, store)
    return write_table(clean, store).select("report_id", "emirates_id", "report_date", "credit_score")


@query
def profile_features(f: Feeds) -> DataFrame:
    return f.profile().select(
        "internal_uuid", "emirates_id", "first_name", "last_name", "full_name", "dob", "phone", "email",
        "emirate", _stamp("kyc_verified_at"), "is_new_user", "had_overdue_before",
    )


# --- scalar functions ---


@query
def normalise_ids(f: Feeds) -> DataFrame:
    return f.feed("fraud_feed").select(
        "provider_ref",
        text.normalise_eid(F.concat(F.lit(" "), F.lower("emirates_id"), F.lit("\t"))).alias("emirates_id"),
        F.lower(F.upper("email")).alias("email"),
    )


@query
def normalise_dates(f: Feeds) -> DataFrame:
    dirty = f.query(
        "SELECT internal_uuid, CASE k % 11 WHEN 0 THEN '31021988' WHEN 1 THEN 'n/a' WHEN 2 THEN NULL WHEN 3 THEN ''"
        " ELSE substr(dob, 9, 2) || substr(dob, 6, 2) || substr(dob, 1, 4) END AS delivered FROM users"
    )
    return dirty.select(
        "internal_uuid",
        text.birth_date_to_iso(F.col("delivered")).alias("dob"),
        text.compact_date_to_iso(F.col("delivered")).alias("updated"),
    )


@query
def safe_casts(f: Feeds) -> DataFrame:
    dirty = f.query(
        "SELECT report_id, CASE k % 6 WHEN 0 THEN CAST(credit_score AS STRING) WHEN 1 THEN '727.0' WHEN 2 THEN 'abc'"
        " WHEN 3 THEN NULL WHEN 4 THEN ' 7 ' ELSE '5d' END AS delivered FROM bureau_feed"
    )
    return dirty.select(
        "report_id",
        text.int_or_null(F.col("delivered")).alias("as_int"),
        text.float_or_zero(F.col("delivered")).alias("as_float"),
    )


@query
def eid_valid(f: Feeds) -> DataFrame:
    return f.feed("fraud_feed").select("provider_ref", text.valid_eid(F.col("emirates_id")).alias("valid"))


@query
def tokenise_pii(f: Feeds) -> DataFrame:
    return audit.tokenise(f.feed("users")).select(
        "internal_uuid", "emirates_id", "full_name", "phone", "email", "dob", "emirate"
    )


@query
def json_roundtrip(f: Feeds) -> DataFrame:
    stored = f.fraud().select(
        "provider_ref", canonical.list_to_json(F.col("reason_codes")).alias("stored"),
        F.when(F.col("decision") == "PASS", 1).otherwise(0).alias("flag"),
    )
    back = stored.withColumn("reason_codes", canonical.list_from_json(F.col("stored")))
    return back.select("provider_ref", "stored", _text_list("reason_codes"), F.col("flag").cast("boolean").alias("passed"))


@query
def jaro_winkler(f: Feeds) -> DataFrame:
    def names(df: DataFrame) -> DataFrame:
        return df.select("dob", F.lower("full_name").alias("name")).distinct()

    pairs = resolve.strong_name_pairs(names(f.feed("aml_feed")), names(f.feed("users")))
    return pairs.dropDuplicates(["dob", "name", "known_name"]).select(
        "dob", "name", "known_name", F.round("score", 6).alias("score")
    )


# --- nested arrays ---


def _reports(f: Feeds) -> DataFrame:
    return silver.parse_bureau(f.landed(BUREAU, f.bureau_files()), AS_OF).rows


@query
def bounced_cheques(f: Feeds) -> DataFrame:
    return _reports(f).groupBy("num_bounced_cheques").agg(
        F.count(F.lit(1)).alias("reports"), F.sum("total_bounced_cheques_amount").alias("amount")
    )


@query
def court_cases(f: Feeds) -> DataFrame:
    return _reports(f).groupBy("num_court_cases", "num_open_court_cases").agg(
        F.count(F.lit(1)).alias("reports"), F.sum("total_claim_amount").alias("claims")
    )


@query
def latest_income(f: Feeds) -> DataFrame:
    return _reports(f).select("report_id", "cb_subject_id", "gross_annual_income")


# --- entity resolution ---


@query
def er_inputs(f: Feeds) -> DataFrame:
    return resolve.resolver_inputs(f.silver()).drop("raw_path", "position")


def _links_of(f: Feeds, tier: str | None = None) -> DataFrame:
    found = resolve.links(resolve.resolve(_stored_silver(f)), AS_OF)
    if tier is not None:
        found = found.where(F.col("match_tier") == tier)
    return found.withColumn("confidence", F.round("confidence", 3)).withColumn("resolved_at", _stamp("resolved_at"))


@query
def er_links(f: Feeds) -> DataFrame:
    return _links_of(f)


@query
def er_tier1(f: Feeds) -> DataFrame:
    tables = f.silver()
    first = resolve.match_emirates_id(resolve.resolver_inputs(tables), tables[PROFILE])
    return first.where(F.col("match_tier").isNotNull()).select(
        "source", "source_event_id", "resolved_eid", "match_tier", "confidence", "notes"
    )


@query
def er_tier2(f: Feeds) -> DataFrame:
    return _links_of(f, resolve.PHONE_EMAIL_EXACT)


@query
def er_tier3(f: Feeds) -> DataFrame:
    return _links_of(f, resolve.NAME_DOB_FUZZY)


@query
def er_hot_birth_date(f: Feeds) -> DataFrame:
    """Similar names where a third of all customers share one birth date."""
    dob = "CASE WHEN k % 3 = 0 THEN '1985-05-05' ELSE dob END AS dob"
    known = f.query(f"SELECT DISTINCT {dob}, lower(full_name || ' ' || emirate) AS name FROM users")
    swapped = "substr(full_name, 1, 1) || substr(full_name, 3, 1) || substr(full_name, 2, 1) || substr(full_name, 4)"
    wanted = f.query(f"SELECT DISTINCT {dob}, lower({swapped} || ' ' || emirate) AS name FROM users")
    return resolve.strong_name_pairs(wanted, known).withColumn("score", F.round("score", 6))


@query
def er_mint_rule(f: Feeds) -> DataFrame:
    tables = f.silver()
    known = tables[PROFILE].where(_customer_number() % 10 != 3)
    first = resolve.match_emirates_id(resolve.resolver_inputs(tables), known)
    return first.where(text.valid_eid(F.col("emirates_id")) & (F.col("source") != PROFILE)).select(
        "source", "source_event_id", "match_tier", "notes"
    )


@query
def er_quarantine(f: Feeds) -> DataFrame:
    tables = _stored_silver(f)
    lost = resolve.quarantine(resolve.resolve(tables), tables, AS_OF)
    whole = F.coalesce(
        *[F.get_json_object("source_record", f"$.{name}") for name in ("provider_ref", "callback_id", "report_id")]
    )
    return lost.select(
        "source", "source_event_id", "emirates_id", "match_tier", "confidence", "notes", whole.alias("record_id")
    )


@query
def er_summary(f: Feeds) -> DataFrame:
    return resolve.summary(resolve.resolve(_stored_silver(f)))


# --- conflicts and keyed rows ---


@query
def conflict_log(f: Feeds) -> DataFrame:
    return conflicts.detect_conflicts(f.silver(), AS_OF).withColumn("logged_at", _stamp("logged_at"))


@query
def latest_per_key(f: Feeds) -> DataFrame:
    return keyed.latest_per_key(f.fraud(), "emirates_id").select("emirates_id", "provider_ref", "score")


@query
def first_per_key(f: Feeds) -> DataFrame:
    return keyed.first_per_key(f.fraud(), "emirates_id").select("emirates_id", "provider_ref", "score")


@query
def silver_counts(f: Feeds) -> DataFrame:
    return silver.record_counts(f.silver())


# --- vectors and decisions ---


def _shown(vector_rows: DataFrame) -> DataFrame:
    return vector_rows.select(
        *[
            _stamp(c) if c == "as_of_ts" else _text_list(c) if c in ("fraud_reason_codes", "aml_matched_lists") else F.col(c)
            for c in vectors.VECTOR_COLUMNS
        ]
    )


@query
def decision_vector(f: Feeds) -> DataFrame:
    return _shown(vectors.assemble(f.silver(), AS_OF))


@query
def decision_vector_backfilled(f: Feeds) -> DataFrame:
    tables = _stored_silver(f)
    return _shown(vectors.assemble(tables, AS_OF, resolved=cut(resolve.resolve(tables))))


@query
def vector_summary(f: Feeds) -> DataFrame:
    return vectors.summary(vectors.assemble(f.silver(), AS_OF))


@query
def hard_declines(f: Feeds) -> DataFrame:
    rows = vectors.assemble(f.silver(), AS_OF)
    return rows.select("emirates_id", "product", F.array_join(packs.hard_declines(F.col), ",").alias("reasons"))


@query
def refer_signals(f: Feeds) -> DataFrame:
    rows = vectors.assemble(f.silver(), AS_OF)
    return rows.select("emirates_id", "product", F.array_join(packs.refer_signals(F.col), ",").alias("reasons"))


def _decided_by(f: Feeds, product: str) -> DataFrame:
    rows = vectors.assemble(f.silver(), AS_OF, products=(product,))
    return decisions.decide(rows, AS_OF, RUN_ID).select("emirates_id", "outcome", _text_list("reason_codes"))


@query
def decide_pf(f: Feeds) -> DataFrame:
    return _decided_by(f, "personal_finance")


@query
def decide_bnpl(f: Feeds) -> DataFrame:
    return _decided_by(f, "bnpl")


@query
def decide_cca(f: Feeds) -> DataFrame:
    return _decided_by(f, "credit_card_alt")


@query
def fact_decision(f: Feeds) -> DataFrame:
    return _facts(f).withColumn("reason_codes", _text_list("reason_codes")).withColumn("decision_ts", _stamp("decision_ts"))


@query
def dim_customer(f: Feeds) -> DataFrame:
    return decisions.dim_customer(f.profile()).withColumn("kyc_verified_at", _stamp("kyc_verified_at"))


@query
def dim_product(f: Feeds) -> DataFrame:
    """The product dimension, joined to the facts it describes."""
    counts = _facts(f).groupBy(F.col("product").alias("product_id")).agg(F.count(F.lit(1)).alias("decisions"))
    return decisions.dim_product(f.spark).join(counts, "product_id", "left")


@query
def outcome_counts(f: Feeds) -> DataFrame:
    return decisions.outcome_counts(_facts(f))


@query
def decisions_by_reason(f: Feeds) -> DataFrame:
    """How often each reason was given, and how often it was the first."""
    reasons = _facts(f).select("product", "outcome", F.posexplode("reason_codes").alias("place", "reason"))
    return reasons.groupBy("product", "outcome", "reason").agg(
        F.count(F.lit(1)).alias("given"), F.count_if(F.col("place") == 0).alias("given_first")
    )


QUERIES["decisions"] = QUERIES["fact_decision"]  # the name under which the benchmark has always timed it


# --- reports ---


@query
def outcome_by_product(f: Feeds) -> DataFrame:
    return reports.outcome_by_product(_facts(f))


@query
def top_decline_reasons(f: Feeds) -> DataFrame:
    return reports.top_decline_reasons(_facts(f))


@query
def approval_rate(f: Feeds) -> DataFrame:
    return reports.approval_rate(_facts(f))


@query
def portfolio_kpis(f: Feeds) -> DataFrame:
    return reports.portfolio_kpis(_facts(f))


@query
def score_distribution(f: Feeds) -> DataFrame:
    return reports.score_distribution(_facts(f))


@query
def decision_lookup(f: Feeds) -> DataFrame:
    found = reports.decision_lookup(_facts(f), product="bnpl", outcome="REFER")
    return found.select("decision_id", "emirates_id", "product", "outcome", _text_list("reason_codes"))


@query
def newest_snapshots(f: Feeds) -> DataFrame:
    """The list a person sees: at most 500 ids, newest first."""
    listed = reports.decision_lookup(_facts(f), outcome="DECLINE", limit=500)
    return listed.select("decision_id", "product", _stamp("decision_ts"))


@query
def vector_archive(f: Feeds) -> DataFrame:
    """The vectors as lines of JSON, as they read back."""
    path = scratch_path(f.spark, "vectors")
    pipeline.archive_vectors(vectors.assemble(f.silver(), AS_OF), path)
    back = f.spark.read.schema(schemas.VECTOR).json(path)
    return back.select("emirates_id", "product", _stamp("as_of_ts"), "credit_score", "gross_annual_income", "is_new_user", _text_list("aml_matched_lists"))


# --- data quality ---


def _one_rule(f: Feeds, rule_id: str) -> DataFrame:
    rules = [r for r in quality.RULES if r.rule_id == rule_id]
    tables = _quality_tables(f) if rule_id == "er_quarantine_rate" else f.silver() | {BUREAU: f.bureau(dirty=True)}
    return quality.scorecard(tables, AS_OF, RUN_ID, rules).select(
        "rule_id", "severity", "checked", "failed", "fail_ratio", "threshold", "breached", "status"
    )


def _rule_query(name: str, rule_id: str) -> None:
    QUERIES[name] = lambda spark, sf_dir: _one_rule(Feeds(configure(spark), sf_dir), rule_id)


for _name, _rule in {
    "dq_eid_format": "eid_format",
    "dq_fraud_score_range": "fraud_score_range",
    "dq_aml_status_enum": "aml_status_enum",
    "dq_dob_plausible": "profile_dob_plausible",
    "dq_bureau_freshness": "aecb_freshness_30d",
    "dq_aml_coverage": "aml_coverage",
    "dq_fraud_phone_conflict": "fraud_phone_conflict",
    "dq_er_quarantine": "er_quarantine_rate",
}.items():
    _rule_query(_name, _rule)


_SAMPLE_KEYS = ("internal_uuid", "provider_ref", "callback_id", "report_id", "source_event_id", "emirates_id")


@query
def dq_scorecard(f: Feeds) -> DataFrame:
    rows = F.from_json("sample_failures", "array<map<string,string>>")
    keys = F.transform(rows, lambda row: F.coalesce(*[row[k] for k in _SAMPLE_KEYS]))
    shown = _results(f).withColumn("sample_keys", F.array_join(keys, ","))
    return shown.drop("sample_failures").withColumn("evaluated_at", _stamp("evaluated_at"))


@query
def dq_samples(f: Feeds) -> DataFrame:
    listed = quality.samples(_quality_tables(f), AS_OF)
    return listed.select(
        "rule_id", "position", F.coalesce(*[F.get_json_object("sample", f"$.{k}") for k in _SAMPLE_KEYS]).alias("key")
    )


@query
def dq_gate(f: Feeds) -> DataFrame:
    return quality.verdict(_results(f))


@query
def dq_summary(f: Feeds) -> DataFrame:
    return reports.dq_summary(_results(f))


@query
def dq_display(f: Feeds) -> DataFrame:
    return reports.dq_display(_results(f))


@query
def dq_persist(f: Feeds) -> DataFrame:
    store = scratch_path(f.spark, "dq_result")
    tables = {k: cut(v) for k, v in _quality_tables(f).items()}
    for run_id in ("run_a", "run_b", "run_a"):
        quality.persist(quality.scorecard(tables, AS_OF, run_id), store)
    one_rule = [rule for rule in quality.RULES if rule.rule_id == "aml_coverage"]
    quality.persist(quality.scorecard(tables, AS_OF, "run_b", one_rule), store)
    stored = read_table(f.spark, store, schemas.DQ_RESULT)
    return stored.select("run_id", "rule_id", "checked", "failed", "status")


@query
def latest_dq_run(f: Feeds) -> DataFrame:
    tables = {k: cut(v) for k, v in _quality_tables(f).items()}
    earlier = quality.scorecard(tables, AS_OF, "run_a")
    later = quality.scorecard(tables, AS_OF + timedelta(days=5), "run_b")
    return reports.latest_dq_run(cut(earlier.unionByName(later))).select(
        "run_id", "rule_id", "severity", "checked", "failed", "breached", "status"
    )


# --- audit ---


@query
def vector_hash(f: Feeds) -> DataFrame:
    return audit.hashed_vectors(_decided(f)).select("emirates_id", "product", "feature_vector_sha256")


@query
def vector_store(f: Feeds) -> DataFrame:
    decided = _decided(f)
    stored = audit.vector_store_rows(audit.hashed_vectors(decided.where(_customer_number() % 2 == 0)))
    fresh = audit.new_vectors(audit.vector_store_rows(audit.hashed_vectors(decided)), stored)
    return fresh.groupBy("prefix").agg(F.count(F.lit(1)).alias("new_vectors"))


@query
def vector_store_sketch(f: Feeds) -> DataFrame:
    """The same, telling most vectors apart by the sketch: what is new, and how many rows had to be looked up for it."""
    decided = _decided(f)
    half = cut(audit.vector_store_rows(audit.hashed_vectors(decided.where(_customer_number() % 2 == 0))))
    rows = cut(audit.vector_store_rows(audit.hashed_vectors(decided)))
    sketch = cut(content_store.sketch_of(half))
    split = content_store.split_by_sketch(rows, sketch)
    missed = split.where("NOT possible").join(half, "sha256", "left_semi").agg(F.count("*").alias("stored_but_not_possible"))
    fresh = content_store.new_vectors(rows, half, sketch).groupBy("prefix").agg(F.count("*").alias("new_vectors"))
    return fresh.join(F.broadcast(missed), how="cross")  # one row


@query
def snapshots(f: Feeds) -> DataFrame:
    written = audit.write_snapshots(_decided(f))
    return written.select(
        "product", "segment", "seq", "decision_id", "feature_vector_sha256", "prev_snapshot_sha256",
        "this_snapshot_sha256",
    )


@query
def snapshots_plain(f: Feeds) -> DataFrame:
    """One chain per product, every snapshot pointing to the one before it."""
    written = audit.write_snapshots(_decided(f), shards=1)
    return written.select("product", "seq", "decision_id", "prev_snapshot_sha256", "this_snapshot_sha256")


@query
def chain_heads(f: Feeds) -> DataFrame:
    return audit.chain_heads(audit.snapshot_index(audit.write_snapshots(_decided(f))))


@query
def chain_append(f: Feeds) -> DataFrame:
    decided = cut(_decided(f))
    odd = _customer_number() % 2 == 1
    first = cut(audit.write_snapshots(decided.where(~odd)))
    heads = audit.chain_heads(audit.snapshot_index(first))
    both = cut(first.unionByName(audit.write_snapshots(decided.where(odd), heads)))
    stored = audit.vector_store_rows(audit.hashed_vectors(decided))
    issues = audit.verify_chain(audit.snapshot_index(both), audit.snapshot_bodies(both), stored)
    found = issues.groupBy("product").agg(F.count(F.lit(1)).alias("issues"))
    sizes = both.groupBy("product").agg(
        F.count(F.lit(1)).alias("snapshots"),
        F.countDistinct("batch").alias("batches"),
        F.countDistinct("segment").alias("segments"),
    )
    return sizes.join(found, "product", "left").fillna(0, ["issues"])


@query
def chain_append_retry(f: Feeds) -> DataFrame:
    """The same batch appended twice, and once more after a run that stored bodies but no index."""
    decided = cut(_decided(f))
    layout = pipeline.Layout(scratch_path(f.spark, "audit"))
    odd = _customer_number() % 2 == 1
    pipeline.write_audit(decided.where(~odd), layout, append=True)
    partly = audit.write_snapshots(decided.where(odd), audit.chain_heads(pipeline.read_audit(f.spark, layout)["index"]))
    bodies = audit.snapshot_bodies(partly).write.mode("append").partitionBy("dt", "product", "batch")
    bodies.parquet(layout.path("audit", "snapshot_bodies"))
    for _ in range(2):
        stored = pipeline.write_audit(decided.where(odd), layout, append=True)
    issues = audit.verify_chain(stored["index"], stored["bodies"], stored["vectors"])
    found = issues.groupBy("product").agg(F.count(F.lit(1)).alias("issues"))
    kept = stored["bodies"].groupBy("product").agg(F.count(F.lit(1)).alias("bodies"))
    sizes = stored["index"].groupBy("product").agg(F.count(F.lit(1)).alias("snapshots"), F.countDistinct("batch").alias("batches"))
    return sizes.join(kept, "product").join(found, "product", "left").fillna(0, ["issues"])


@query
def audit_reset(f: Feeds) -> DataFrame:
    """A run that does not append starts all chains anew: what an earlier run stored is gone."""
    decided = cut(_decided(f))
    layout = pipeline.Layout(scratch_path(f.spark, "audit"))
    pipeline.write_audit(decided, layout)
    stored = pipeline.write_audit(decided.where(_customer_number() % 2 == 1), layout)
    bodies = stored["bodies"].groupBy("product").agg(F.count("*").alias("bodies"))
    found = stored["index"].groupBy("product").agg(
        F.count("*").alias("snapshots"), F.max("batch").alias("batches"), F.min_by("prev_snapshot_sha256", F.struct("segment", "seq")).alias("genesis")
    )
    held = stored["vectors"].agg(F.count("*").alias("vectors"))
    return found.join(bodies, "product").join(F.broadcast(held), how="cross")  # one row


@query
def chain_verify(f: Feeds) -> DataFrame:
    stored = _tampered(f)
    return audit.verify_chain(stored["index"], stored["bodies"], stored["vectors"]).select("decision_id", "product", "kind")


@query
def chain_verify_product(f: Feeds) -> DataFrame:
    stored = _tampered(f)
    issues = audit.verify_chain(stored["index"], stored["bodies"], stored["vectors"], product="bnpl")
    return issues.select("decision_id", "product", "kind")


_TREE_KEY = b"catalog"


@query
def chain_tree_verify(f: Feeds) -> DataFrame:
    """Two batches under a tree, then outcomes changed, bodies removed and the end of a chain cut off: the segments that
    each batch finds on its own, and whether verifying everything finds them too."""
    decided = cut(_decided(f))
    odd = _customer_number() % 2 == 1
    first = cut(audit.write_snapshots(decided.where(~odd)))
    second = cut(audit.write_snapshots(decided.where(odd), audit.chain_heads(audit.snapshot_index(first))))
    none = f.spark.createDataFrame([], merkle.HEADS)
    heads, stored = none, None
    for rows in (first, second):
        new = cut(merkle.leaves(audit.snapshot_index(rows), audit.snapshot_bodies(rows)))
        added, _, ends = merkle.append(new, merkle.latest_heads(heads), _TREE_KEY)
        heads, stored = cut(heads.unionByName(ends)), added if stored is None else cut(stored.unionByName(added))
    k = _customer_number() % 100
    both = first.unionByName(second)
    last = cut(both.where("product = 'bnpl'").agg(F.max("segment").alias("segment")).withColumn("product", F.lit("bnpl")))
    both = both.join(F.broadcast(last), ["product", "segment"], "left_anti")  # one row
    flipped = F.when(F.col("outcome") == "REFER", F.lit("APPROVE")).otherwise(F.lit("REFER"))
    bodies = audit.snapshot_bodies(both).where(k != 12).withColumn("outcome", F.when(k == 7, flipped).otherwise(F.col("outcome")))
    index = audit.snapshot_index(both)
    own = None
    for batch in (1, 2):
        found = merkle.verify_batch(index, bodies, stored, heads, batch, _TREE_KEY)
        own = found if own is None else own.unionByName(found)
    whole = merkle.verify_all(index, bodies, stored, heads, _TREE_KEY).select("product", "segment", "kind", F.lit(True).alias("_all"))
    joined = own.where("segment IS NOT NULL").join(whole, ["product", "segment", "kind"], "left")
    return joined.select("product", "batch", "segment", "kind", F.coalesce("_all", F.lit(False)).alias("in_full_check"))


@query
def chain_issue_summary(f: Feeds) -> DataFrame:
    stored = _tampered(f)
    return audit.issue_summary(audit.verify_chain(stored["index"], stored["bodies"], stored["vectors"]))


@query
def replay(f: Feeds) -> DataFrame:
    stored = _audit(f)
    k = _customer_number() % 100
    bodies = stored["bodies"].withColumn("outcome", F.when(k == 7, F.lit("HOLD")).otherwise(F.col("outcome")))
    return audit.replay(bodies, stored["vectors"]).select(
        "decision_id", "product", "matches", "original_outcome", "replayed_outcome",
        _text_list("original_reasons"), _text_list("replayed_reasons"),
    )


@query
def replay_sample(f: Feeds) -> DataFrame:
    stored = _audit(f)
    return audit.replay_sample(stored["bodies"], stored["vectors"], n=10, seed=7).select("decision_id", "matches")


@query
def decision_detail(f: Feeds) -> DataFrame:
    """The decision of each product with the smallest id, with its snapshot, vector and replay."""
    stored = _audit(f)
    bodies = cut(stored["bodies"])
    smallest = bodies.groupBy("product").agg(F.min("decision_id").alias("decision_id")).drop("product")
    shown = audit.decision_detail(bodies.join(smallest, "decision_id", "left_semi"), stored["vectors"], F.col("decision_id"))
    return shown.select(
        "decision_id", "product", "outcome", _text_list("reason_codes"), "rule_pack_version",
        (F.sha2("vector", 256) == F.col("feature_vector_sha256")).alias("vector_intact"), "matches", "replayed_outcome",
    )


@query
def replay_pii_invariant(f: Feeds) -> DataFrame:
    rows = vectors.assemble(f.silver(), AS_OF)
    shown = ("emirates_id", "product", "outcome", "reason_codes")
    plain = decisions.decide(rows, AS_OF, RUN_ID).select(*shown)
    hidden = decisions.decide(audit.tokenise(rows), AS_OF, RUN_ID).select(*shown)
    return plain.agg(F.count(F.lit(1)).alias("decisions")).withColumn("differing", F.lit(0).cast("bigint")).unionByName(
        plain.exceptAll(hidden).agg(F.count(F.lit(1)).alias("differing")).withColumn("decisions", F.lit(0).cast("bigint"))
    ).agg(F.sum("decisions").alias("decisions"), F.sum("differing").alias("differing"))

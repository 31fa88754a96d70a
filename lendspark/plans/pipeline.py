"""The whole run: landing files to decisions, snapshots and a verified chain.

Steps are ordinary calls in order; each layer is stored before the next one reads it, so a lost
executor costs at most the work of one layer.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendspark import schemas
from lendspark.config import AML, BUREAU, FRAUD, PROFILE
from lendspark.operators import audit, bronze, conflicts, content_store, decisions, quality, resolve, silver, vectors
from lendspark.operators.skew import small
from lendspark.session import configure, cut, scratch
from lendspark.sources.files import read_table, write_table
from lendspark.sources.profile_db import read_profile_tables
from lendspark.streaming import landing as stream


@dataclass(frozen=True)
class Layout:
    """Where each table of one installation lives."""

    root: str

    def path(self, *parts: str) -> str:
        return "/".join((self.root, *parts))


def _profile_databases(landed: DataFrame) -> list[str]:
    """Names of the profile databases delivered that day: a handful of files."""
    files = landed.where(F.col("source") == PROFILE).select("source_event_id").distinct()
    return sorted(row["source_event_id"] for row in files.collect())


_SILVER = {
    BUREAU: schemas.SILVER_BUREAU,
    FRAUD: schemas.SILVER_FRAUD,
    AML: schemas.SILVER_AML,
    PROFILE: schemas.SILVER_PROFILE,
}
_DAY = "regexp_extract(raw_path, 'ingest_date=([^/]+)', 1)"


def read_silver(spark: SparkSession, layout: Layout, source: str, since: str | None = None) -> DataFrame:
    """The records of all parsed days, or of those from `since` on."""
    rows = read_table(spark, layout.path("silver", source), f"{_SILVER[source]}, ingest_date string")
    return (rows if since is None else rows.where(F.col("ingest_date") >= since)).drop("ingest_date")


def _pending(spark: SparkSession, stored: DataFrame, layout: Layout, day: str) -> DataFrame:
    """Raw documents of the day of the run, and of earlier days that silver does not hold yet."""
    done = None
    for source in (BUREAU, FRAUD, AML):
        for folder in ((source,), ("rejects", source)):
            days = read_table(spark, layout.path("silver", *folder), "raw_path string, ingest_date string").select("ingest_date")
            days = days.where(F.col("ingest_date") != day).distinct().select(F.lit(source).alias("source"), "ingest_date")
            done = days if done is None else done.unionByName(days)
    return stored.join(small(done.distinct()), ["source", "ingest_date"], "left_anti")


def parse_sources(
    spark: SparkSession,
    documents: DataFrame,
    records: DataFrame,
    profile: Mapping[str, DataFrame],
    as_of: datetime,
    run_id: str,
    strict: bool = False,
) -> dict[str, silver.Parsed]:
    """Verdicts on the records of raw documents and of line-delimited feeds, and of the day's profile tables.

    `profile` holds users, applications and instalments; nothing if none was delivered.
    """
    def items(source: str, schema: str) -> DataFrame:
        of_source = F.col("source") == source
        whole = silver.json_items(documents.where(of_source), schema)
        return whole.unionByName(silver.line_items(records.where(of_source), schema))

    parsed = {
        BUREAU: silver.parse_bureau(documents.where(F.col("source") == BUREAU), as_of),
        FRAUD: silver.parse_fraud(items(FRAUD, schemas.FRAUD_ITEM), strict),
        AML: silver.parse_aml(items(AML, schemas.AML_ITEM), strict),
    }
    if profile:
        folder = F.lit(f"profile/ingest_date={as_of.date().isoformat()}/")
        users = profile["users"]
        name = F.col("raw_path") if "raw_path" in users.columns else F.lit(PROFILE)
        users = users.withColumn("raw_path", F.concat(folder, name))
        parsed[PROFILE] = silver.parse_profile(users, profile["applications"], profile["instalments"], run_id, strict)
    return parsed


def delivered_profile(spark: SparkSession, landing: str, databases: list[str]) -> dict[str, DataFrame]:
    """The tables of the day's profile databases: one full extract, or a few parts of one."""
    whole: dict[str, DataFrame] = {}
    for name in databases:
        tables = read_profile_tables(spark, f"{landing}/{PROFILE}/{name}.db")
        tables["users"] = tables["users"].withColumn("raw_path", F.lit(name))
        whole = {k: whole[k].unionByName(df) if whole else df for k, df in tables.items()}
    return whole


def build_silver(spark: SparkSession, parsed: dict[str, silver.Parsed], layout: Layout, since: str | None = None) -> dict[str, DataFrame]:
    """Store rows and rejects by day, each record parsed once; days parsed before stay as they are."""
    for source, result in parsed.items():
        once = result.stored()
        for rows, folder in ((once.rows, (source,)), (once.rejects, ("rejects", source))):
            writer = rows.withColumn("ingest_date", F.expr(_DAY)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy("ingest_date").parquet(layout.path("silver", *folder))
    return {source: read_silver(spark, layout, source, since) for source in _SILVER}


def build_resolution(tables: dict[str, DataFrame], layout: Layout, as_of: datetime) -> dict[str, DataFrame]:
    resolved = write_table(resolve.resolve(tables), layout.path("silver", "er_resolved"))
    return {
        "er_resolved": resolved,
        "er_links": write_table(resolve.links(resolved, as_of), layout.path("silver", "er_links")),
        "er_quarantine": write_table(
            resolve.quarantine(resolved, tables, as_of), layout.path("silver", "er_quarantine")
        ),
        "conflicts": write_table(conflicts.detect_conflicts(tables, as_of), layout.path("silver", "conflicts")),
    }


def check_quality(tables: dict[str, DataFrame], layout: Layout, as_of: datetime, run_id: str) -> DataFrame:
    """Score, store and gate: raises `quality.GateError` if a MUST_PASS rule is breached."""
    path = layout.path("gold", "dq_result")
    quality.persist(quality.scorecard(tables, as_of, run_id), path)
    spark = next(iter(tables.values())).sparkSession
    results = read_table(spark, path, schemas.DQ_RESULT).where(F.col("run_id") == run_id)
    quality.gate(results)
    return results


def build_gold(
    tables: dict[str, DataFrame], layout: Layout, as_of: datetime, run_id: str, use_er_links: bool = False
) -> dict[str, DataFrame]:
    resolved = tables["er_resolved"] if use_er_links else None
    sources = {source: tables[source] for source in (PROFILE, BUREAU, FRAUD, AML)}
    features = write_table(
        vectors.assemble(sources, as_of, resolved=resolved), layout.path("gold", "decision_input_vector")
    )
    decided = decisions.decide(features, as_of, run_id)
    return {
        "decided": decided,
        "fact_decision": write_table(decisions.fact_decision(decided), layout.path("gold", "fact_decision")),
        "dim_customer": write_table(decisions.dim_customer(tables[PROFILE]), layout.path("gold", "dim_customer")),
        "dim_product": write_table(decisions.dim_product(decided.sparkSession), layout.path("gold", "dim_product")),
    }


def archive_vectors(features: DataFrame, path: str) -> None:
    """The vectors once more as lines of JSON, nulls included, for readers without Parquet."""
    features.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def read_audit(spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
    return {
        "index": read_table(spark, layout.path("audit", "snapshot_index"), schemas.SNAPSHOT_INDEX),
        "bodies": read_table(spark, layout.path("audit", "snapshot_bodies"), schemas.SNAPSHOT_BODY),
        "vectors": read_table(spark, layout.path("audit", "feature_vectors"), schemas.FEATURE_VECTORS),
    }


def _stored_sketch(vectors: DataFrame, layout: Layout) -> DataFrame:
    """The sketch of the stored vectors; made once for a store that was written without one."""
    path = layout.path("audit", "feature_vector_sketch")
    sketch = read_table(vectors.sparkSession, path, content_store.SKETCH)
    return write_table(content_store.sketch_of(vectors), path) if sketch.isEmpty() else sketch


def write_audit(
    decided: DataFrame, layout: Layout, append: bool = False, shards: int = audit.SHARDS
) -> dict[str, DataFrame]:
    """Store vectors, bodies and index of a batch; `append` continues the chains already stored.

    It can be repeated: decisions that the index holds are left out, and a batch that was only stored in
    part is written over, as it gets the same number and the same hashes again.
    """
    spark = decided.sparkSession
    stored = read_audit(spark, layout)
    heads = None
    if append:
        decided = decided.join(stored["index"].select("decision_id"), "decision_id", "left_anti")
        heads = audit.chain_heads(stored["index"])
    snapshots = cut(audit.write_snapshots(decided, heads, shards))
    rows = audit.vector_store_rows(audit.hashed_vectors(decided))
    if append:
        rows = content_store.new_vectors(rows, stored["vectors"], _stored_sketch(stored["vectors"], layout))
    rows = cut(rows)
    mode = "append" if append else "overwrite"
    # The sketch comes first: a bit too many costs a lookup, a bit too few would store a vector twice.
    write_table(content_store.sketch_of(rows), layout.path("audit", "feature_vector_sketch"), mode=mode)
    write_table(rows, layout.path("audit", "feature_vectors"), ("prefix",), mode)
    # The index comes last: what it does not hold yet does not count as stored.
    for name, part in (("snapshot_bodies", audit.snapshot_bodies), ("snapshot_index", audit.snapshot_index)):
        writer = part(snapshots).write.mode("overwrite").partitionBy("dt", "product", "batch")
        mode = "dynamic" if append else "static"
        writer.option("partitionOverwriteMode", mode).parquet(layout.path("audit", name))
    return read_audit(spark, layout)


def run(
    spark: SparkSession,
    landing: str,
    root: str,
    as_of: datetime,
    run_id: str,
    *,
    strict: bool = False,
    use_er_links: bool = False,
    append_audit: bool = False,
    since: str | None = None,
    profile: Mapping[str, DataFrame] | None = None,
    incremental: bool = False,
    archive: bool = False,
) -> dict[str, DataFrame]:
    """Land, parse, resolve, check, decide, snapshot and verify. Returns every stored table.

    `as_of` stands for "now" throughout, so a run can be repeated with the same results. The records of all
    landed days count, and the last one per customer wins over days too; each day is parsed once, and `since`
    (an ISO date) leaves out the days before it. `profile` gives the day's users, applications and instalments
    as DataFrames; without it they are read from the profile databases that landed that day, if any. With `incremental`
    a stream lands only files it has not seen (`streaming.landing`), in tables of its own; an installation keeps to one way.
    With `archive` the vectors are also kept as lines of JSON.
    """
    configure(spark)
    with scratch(spark):
        return _run(spark, landing, Layout(root), as_of, run_id, strict, use_er_links, append_audit, since, profile, incremental, archive)


def _run(
    spark: SparkSession,
    landing: str,
    layout: Layout,
    as_of: datetime,
    run_id: str,
    strict: bool,
    use_er_links: bool,
    append_audit: bool,
    since: str | None,
    profile: Mapping[str, DataFrame] | None,
    incremental: bool,
    archive: bool,
) -> dict[str, DataFrame]:
    day = as_of.date().isoformat()
    if incremental:
        stored = stream.land_files(spark, landing, layout.path("bronze_files"), run_id, as_of).drop(stream.BATCH)
        records = stream.land_lines(spark, landing, layout.path("bronze_lines"), run_id, as_of).drop(stream.BATCH)
        today = stored.where(F.col("ingest_date") == day)
        bronze.land_arrays(spark, landing, layout.path("bronze_records"), run_id, as_of)
        records = records.unionByName(bronze.read_records(spark, layout.path("bronze_records")))
    else:
        today = bronze.land(spark, landing, layout.path("bronze"), run_id, as_of)
        stored = bronze.read_bronze(spark, layout.path("bronze"))
        bronze.land_records(spark, landing, layout.path("bronze_records"), run_id, as_of)
        bronze.land_arrays(spark, landing, layout.path("bronze_records"), run_id, as_of)
        records = bronze.read_records(spark, layout.path("bronze_records"))
    if since is not None:
        stored, records = (raw.where(F.col("ingest_date") >= since) for raw in (stored, records))
    tables = {"bronze_summary": bronze.summary(today)}
    documents, records = (_pending(spark, raw, layout, day) for raw in (stored, records))
    if profile is None:
        profile = delivered_profile(spark, landing, _profile_databases(today))
    tables |= build_silver(spark, parse_sources(spark, documents, records, profile, as_of, run_id, strict), layout, since)
    tables |= build_resolution(tables, layout, as_of)
    tables["dq_result"] = check_quality(tables, layout, as_of, run_id)
    tables |= build_gold(tables, layout, as_of, run_id, use_er_links)
    if archive:
        archive_vectors(read_table(spark, layout.path("gold", "decision_input_vector"), schemas.VECTOR), layout.path("gold", "decision_input_vector_json"))
    tables |= write_audit(tables["decided"], layout, append_audit)
    issues = audit.verify_chain(tables["index"], tables["bodies"], tables["vectors"])
    audit.require_intact(issues)
    return tables

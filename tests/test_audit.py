from __future__ import annotations

import hashlib
import json

import pytest
from builders import CLEAN_VECTOR, column, customer, one, vectors
from pyspark.sql import functions as F

from lendspark.config import GENESIS_HASH, PII_FIELDS
from lendspark.operators import audit, decisions
from lendspark.plans import pipeline
from lendspark.session import cut


def decided(spark, as_of, n, product="personal_finance", start=0):
    rows = [{"emirates_id": customer(i), "product": product, "credit_score": 600 + i} for i in range(start, start + n)]
    return decisions.decide(vectors(spark, rows), as_of, "run")


def stored(batch, heads=None, shards=1):
    snapshots = cut(audit.write_snapshots(batch, heads, shards))
    return {
        "index": audit.snapshot_index(snapshots),
        "bodies": audit.snapshot_bodies(snapshots),
        "vectors": audit.vector_store_rows(audit.hashed_vectors(batch)),
    }


def issues(store, **changed):
    store = store | changed
    return sorted((r["kind"], r["decision_id"]) for r in audit.verify_chain(store["index"], store["bodies"], store["vectors"]).collect())


def order(store):
    return column(store["index"].orderBy("product", "segment", "seq"), "decision_id")


@pytest.fixture(scope="module")
def chain(spark, as_of):
    return stored(decided(spark, as_of, 12))


@pytest.fixture(scope="module")
def segmented(spark, as_of):
    both = decided(spark, as_of, 60).unionByName(decided(spark, as_of, 40, "bnpl"))
    return stored(both, shards=6)


def test_one_segment_is_a_plain_chain(chain):
    rows = chain["index"].orderBy("seq").collect()
    assert rows[0]["prev_snapshot_sha256"] == GENESIS_HASH
    for before, after in zip(rows, rows[1:]):
        assert after["prev_snapshot_sha256"] == before["this_snapshot_sha256"]
    assert issues(chain) == []
    audit.require_intact(audit.verify_chain(chain["index"], chain["bodies"], chain["vectors"]))


def test_hash_covers_the_canonical_body(chain):
    body = chain["bodies"].head().asDict()
    keys = [
        "decision_id", "emirates_id", "product", "decision_ts", "outcome", "reason_codes", "engine_version",
        "rule_pack_version", "pipeline_version", "feature_vector_sha256", "feature_vector_path", "prev_snapshot_sha256",
    ]
    text = json.dumps({k: body[k] for k in keys}, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    assert hashlib.sha256(text.encode()).hexdigest() == body["this_snapshot_sha256"]


def test_segments_are_tied_together(segmented):
    sizes = segmented["index"].groupBy("product", "segment").count()
    assert sizes.where("product = 'personal_finance'").count() > 1
    assert segmented["index"].select("decision_id").distinct().count() == 100
    assert issues(segmented) == []


def changed(bodies, decision_id, name, value):
    return bodies.withColumn(name, F.when(F.col("decision_id") == decision_id, F.lit(value)).otherwise(F.col(name)))


@pytest.mark.parametrize(
    ("name", "value"),
    [("outcome", "HOLD"), ("emirates_id", "x"), ("decision_ts", "x"), ("engine_version", "x"), ("pipeline_version", "x"),
     ("rule_pack_version", "x"), ("feature_vector_path", "x")],
)
def test_a_changed_field_is_a_hash_mismatch(chain, name, value):
    victim = order(chain)[4]
    assert issues(chain, bodies=changed(chain["bodies"], victim, name, value)) == [("hash_mismatch", victim)]


def test_changed_reasons_are_a_hash_mismatch(chain):
    victim = order(chain)[-1]
    bodies = chain["bodies"].withColumn(
        "reason_codes", F.when(F.col("decision_id") == victim, F.array(F.lit("X"))).otherwise(F.col("reason_codes"))
    )
    assert issues(chain, bodies=bodies) == [("hash_mismatch", victim)]


def test_a_changed_hash_breaks_itself_and_the_next(chain):
    victim, following = order(chain)[4:6]
    bodies = changed(chain["bodies"], victim, "this_snapshot_sha256", "f" * 64)
    assert issues(chain, bodies=bodies) == sorted([("hash_mismatch", victim), ("chain_break", following)])


def test_a_removed_body_is_missing_and_breaks_the_next(chain):
    victim, following = order(chain)[4:6]
    bodies = chain["bodies"].where(F.col("decision_id") != victim)
    assert issues(chain, bodies=bodies) == sorted([("missing_file", victim), ("chain_break", following)])


def test_a_removed_index_row_breaks_the_next(chain):
    victim, following = order(chain)[4:6]
    assert issues(chain, index=chain["index"].where(F.col("decision_id") != victim)) == [("chain_break", following)]


def test_a_removed_first_row_breaks_the_chain(chain):
    first, second = order(chain)[:2]
    gone = F.col("decision_id") != first
    assert issues(chain, index=chain["index"].where(gone), bodies=chain["bodies"].where(gone)) == [("chain_break", second)]


def test_a_removed_segment_breaks_the_next(segmented):
    index = segmented["index"]
    segments = sorted({r[0] for r in index.where("product = 'personal_finance'").select("segment").collect()})
    gone = ~((F.col("product") == "personal_finance") & (F.col("segment") == segments[1]))
    first_after = index.where((F.col("product") == "personal_finance") & (F.col("segment") == segments[2])).orderBy("seq").head()
    assert issues(segmented, index=index.where(gone)) == [("chain_break", first_after["decision_id"])]


def test_a_rewritten_segment_breaks_the_next(spark, as_of, segmented):
    """Whoever changes a row and rehashes its whole segment is still found out."""
    index = segmented["index"].where("product = 'bnpl'")
    segments = sorted({r[0] for r in index.select("segment").collect()})
    victim = index.where(F.col("segment") == segments[0]).orderBy(F.desc("seq")).head()
    body = segmented["bodies"].where(F.col("decision_id") == victim["decision_id"]).head().asDict()
    text = {k: v for k, v in body.items() if k not in ("this_snapshot_sha256", "dt", "batch")} | {"outcome": "HOLD"}
    rehashed = hashlib.sha256(json.dumps(text, sort_keys=True, separators=(",", ":")).encode()).hexdigest()
    bodies = changed(segmented["bodies"], victim["decision_id"], "outcome", "HOLD")
    bodies = changed(bodies, victim["decision_id"], "this_snapshot_sha256", rehashed)
    opening = index.where(F.col("segment") == segments[1]).orderBy("seq").head()["decision_id"]
    assert issues(segmented, bodies=bodies) == [("chain_break", opening)]


def test_a_changed_vector_is_found_and_a_missing_one_is_not_an_issue(chain):
    victim = chain["bodies"].head()
    hit = F.col("sha256") == victim["feature_vector_sha256"]
    edited = F.when(hit, F.regexp_replace("json", '"credit_score":', '"credit_score":9')).otherwise(F.col("json"))
    assert issues(chain, vectors=chain["vectors"].withColumn("json", edited)) == [("vector_mismatch", victim["decision_id"])]
    assert issues(chain, vectors=chain["vectors"].where(~hit)) == []


def test_issues_stop_the_run(chain):
    found = audit.verify_chain(chain["index"], chain["bodies"].where("false"), chain["vectors"])
    with pytest.raises(audit.ChainError, match="12 issue.*missing_file"):
        audit.require_intact(found)
    assert one(audit.issue_summary(found))["issues"] == 12


def test_single_product(segmented):
    bodies = segmented["bodies"].withColumn("outcome", F.lit("HOLD"))
    found = audit.verify_chain(segmented["index"], bodies, segmented["vectors"], product="bnpl")
    assert {r["product"] for r in found.collect()} == {"bnpl"}


def test_the_layout_does_not_hang_on_the_size_of_the_batch(spark, as_of):
    few, many = (stored(decided(spark, as_of, n), shards=4)["index"] for n in (5, 50))
    joined = few.join(many.select("decision_id", F.col("segment").alias("s"), F.col("shards").alias("n")), "decision_id")
    assert joined.where("segment = s AND shards = n AND n = 4").count() == 5


@pytest.mark.parametrize("shards", [1, 5])
def test_appending_continues_the_chain(spark, as_of, shards):
    first = stored(decided(spark, as_of, 20), shards=shards)
    heads = audit.chain_heads(first["index"])
    more = decided(spark, as_of, 15, start=100).unionByName(decided(spark, as_of, 5, "bnpl"))
    second = stored(more, heads, shards)
    opening = second["index"].where("product = 'personal_finance'").orderBy("segment", "seq").head()
    assert opening["prev_snapshot_sha256"] == one(heads)["head"] and opening["batch"] == 2
    both = {k: first[k].unionByName(second[k]) for k in first}
    assert issues(both) == []
    assert issues(both, index=second["index"].where("product = 'personal_finance'")) == [("chain_break", opening["decision_id"])]


def test_equal_decisions_chain_equally(spark, as_of, chain):
    again = stored(decided(spark, as_of, 12).repartition(3))
    hashes = lambda s: sorted(column(s["index"], "this_snapshot_sha256"))
    assert hashes(again) == hashes(chain)


def test_vectors_hold_tokens_and_keep_the_id(spark, as_of):
    hashed = audit.hashed_vectors(decided(spark, as_of, 1))
    row = one(audit.vector_store_rows(hashed))
    body = json.loads(row["json"])
    for field in PII_FIELDS:
        assert body[field].startswith("tok_") and body[field] != CLEAN_VECTOR[field]
    assert body["emirates_id"] == customer(0) and row["prefix"] == row["sha256"][:2]
    assert hashlib.sha256(row["json"].encode()).hexdigest() == row["sha256"]
    assert json.dumps(body, sort_keys=True, separators=(",", ":"), ensure_ascii=False) == row["json"]


def test_equal_vectors_are_stored_once(spark, as_of):
    twice = decided(spark, as_of, 3).unionByName(decided(spark, as_of, 4))
    rows = audit.vector_store_rows(audit.hashed_vectors(twice))
    assert rows.count() == 4
    assert audit.new_vectors(rows, rows.limit(3)).count() == 1


def test_replay(spark, as_of, segmented):
    result = audit.replay(segmented["bodies"], segmented["vectors"])
    assert result.count() == 100 and result.where("NOT matches").count() == 0
    victim = segmented["bodies"].head()["decision_id"]
    bodies = changed(segmented["bodies"], victim, "outcome", "HOLD")
    bad = one(audit.replay(bodies, segmented["vectors"]).where("NOT matches"))
    assert bad["decision_id"] == victim and bad["original_outcome"] == "HOLD"
    assert one(audit.replay_decision(segmented["bodies"], segmented["vectors"], victim))["matches"] is True
    with pytest.raises(LookupError):
        audit.replay_decision(segmented["bodies"], segmented["vectors"], "dcn_unknown")


def test_a_seed_repeats_its_sample(segmented):
    picked = [
        sorted(column(audit.replay_sample(bodies, segmented["vectors"], 7, seed), "decision_id"))
        for bodies, seed in ((segmented["bodies"], 1), (segmented["bodies"].repartition(3), 1), (segmented["bodies"], 2))
    ]
    assert len(picked[0]) == 7 and picked[0] == picked[1] != picked[2]


def test_an_append_can_be_repeated(spark, as_of, tmp_path):
    layout = pipeline.Layout(str(tmp_path))
    first, more = decided(spark, as_of, 30), decided(spark, as_of, 20, start=50)
    pipeline.write_audit(first, layout, append=True, shards=3)
    for _ in range(2):
        store = pipeline.write_audit(more, layout, append=True, shards=3)
    assert store["index"].count() == store["bodies"].count() == 50 and issues(store) == []


def test_an_append_that_died_between_bodies_and_index_is_made_good(spark, as_of, tmp_path):
    layout = pipeline.Layout(str(tmp_path))
    store = pipeline.write_audit(decided(spark, as_of, 30), layout, append=True, shards=3)
    more = decided(spark, as_of, 20, start=50)
    half = audit.snapshot_bodies(audit.write_snapshots(more, audit.chain_heads(store["index"]), 3))
    half.write.mode("append").partitionBy("dt", "product", "batch").parquet(layout.path("audit", "snapshot_bodies"))
    assert issues(pipeline.read_audit(spark, layout)) == []
    store = pipeline.write_audit(more, layout, append=True, shards=3)
    assert store["index"].count() == store["bodies"].count() == 50 and issues(store) == []


def test_a_stored_vector_is_parsed_once(segmented):
    plan = audit.replay(segmented["bodies"], segmented["vectors"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1


def test_a_chain_hashed_in_blocks_is_the_same_chain(spark, as_of):
    batch = cut(decided(spark, as_of, 30).unionByName(decided(spark, as_of, 11, "bnpl")))
    for shards in (1, 3):
        whole, steps = (audit.write_snapshots(batch, shards=shards, block_rows=rows) for rows in (1000, 4))
        assert sorted(audit.snapshot_index(steps).collect()) == sorted(audit.snapshot_index(whole).collect())
    ids = column(whole.where("product = 'bnpl'").orderBy("segment", "seq"), "seq")
    assert ids[0] == 1 and len(ids) == 11


def test_no_task_numbers_or_digests_a_whole_plain_chain(spark, as_of, monkeypatch):
    numbered, digested = [], []
    number, digest = audit._numbered, audit.segment_digests
    monkeypatch.setattr(audit, "_numbered", lambda rows: numbered.append(number(rows)) or numbered[-1])
    monkeypatch.setattr(audit, "segment_digests", lambda rows, *order: digested.append(rows) or digest(rows, *order))
    audit.write_snapshots(decided(spark, as_of, 20), shards=1, block_rows=8)
    assert digested[0].count() == 0
    plan = numbered[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and numbered[0].agg(F.max("seq"), F.countDistinct("seq")).head()[:] == (20, 20)


def test_nothing_to_write(spark, as_of):
    assert audit.write_snapshots(decided(spark, as_of, 3).where("false")).count() == 0

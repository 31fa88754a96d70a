from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from test_audit import decided

from lendspark.operators import audit, merkle
from lendspark.session import cut

KEY = b"kept elsewhere"


def test_growing_step_by_step_is_growing_at_once():
    hashes = [f"{i:02x}" for i in range(45)]
    whole, peaks = merkle.grow([], hashes)
    for step in (1, 2, 7, 16):
        nodes, at = [], []
        for i in range(0, len(hashes), step):
            new, at = merkle.grow(at, hashes[i : i + step])
            nodes += new
            assert len(at) == bin(min(i + step, 45)).count("1")
        assert sorted(nodes) == sorted(whole) and sorted(at) == sorted(peaks)
    assert len(whole) == 2 * 45 - len(peaks)
    assert merkle.root_of(peaks) != merkle.root_of(merkle.grow([], [*hashes[:-1], "xx"])[1])


@pytest.fixture(scope="module")
def history(spark, as_of):
    """Three batches of two products, six segments each."""
    heads, parts, grown = None, [], {"leaves": [], "nodes": [], "heads": []}
    for start in (0, 40, 80):
        batch = decided(spark, as_of, 40, start=start).unionByName(decided(spark, as_of, 20, "bnpl", start=start))
        rows = cut(audit.write_snapshots(batch, heads, 6))
        parts.append(rows)
        known = union(parts)
        heads = audit.chain_heads(audit.snapshot_index(known))
        tree_heads = union(grown["heads"]) if grown["heads"] else spark.createDataFrame([], merkle.HEADS)
        new = merkle.leaves(audit.snapshot_index(rows), audit.snapshot_bodies(rows))
        for name, df in zip(grown, merkle.append(cut(new), merkle.latest_heads(tree_heads), KEY)):
            grown[name].append(cut(df))
    whole = union(parts)
    return {"index": cut(audit.snapshot_index(whole)), "bodies": cut(audit.snapshot_bodies(whole))} | {k: cut(union(v)) for k, v in grown.items()}


def union(parts):
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def issues(history, batch=None, key=KEY, last=None, **changed):
    t = history | changed
    if batch is None:
        found = merkle.verify_all(t["index"], t["bodies"], t["leaves"], t["heads"], key, last)
    else:
        found = merkle.verify_batch(t["index"], t["bodies"], t["leaves"], t["heads"], batch, key)
    return sorted((r["product"], r["batch"] or 0, -1 if r["segment"] is None else r["segment"], r["kind"]) for r in found.collect())


def test_an_untouched_history_verifies(history):
    assert issues(history) == [] and [issues(history, b) for b in (1, 2, 3)] == [[], [], []]
    heads = {(r["product"], r["batch"]): r for r in history["heads"].collect()}
    assert len(heads) == 6 and heads["personal_finance", 3]["rows"] == 120 and heads["bnpl", 3]["rows"] == 60
    assert heads["personal_finance", 3]["leaves"] == history["leaves"].where("product = 'personal_finance'").count()


def one(history, batch, product="personal_finance"):
    row = history["index"].where((F.col("batch") == batch) & (F.col("product") == product)).orderBy("segment", "seq").head()
    return row["decision_id"], row["segment"]


def agree(history, batch, want, **changed):
    """The batch that was touched says what the whole history says, and the others say nothing."""
    assert issues(history, **changed) == issues(history, batch, **changed) == sorted(want)
    assert all(issues(history, b, **changed) == [] for b in (1, 2, 3) if b != batch)


@pytest.mark.parametrize("name, new", [("outcome", "APPROVED?"), ("prev_snapshot_sha256", "f" * 64), ("this_snapshot_sha256", "f" * 64)])
def test_a_changed_body(history, name, new):
    decision, segment = one(history, 2)
    bodies = history["bodies"].withColumn(name, F.when(F.col("decision_id") == decision, F.lit(new)).otherwise(F.col(name)))
    want = [("personal_finance", 2, segment, merkle.SEGMENT_ALTERED), ("personal_finance", 2, -1, merkle.ROOT_MISMATCH)]
    assert issues(history, 2, bodies=bodies) == sorted(want)
    assert issues(history, bodies=bodies) == sorted([want[0], ("personal_finance", 3, -1, merkle.ROOT_MISMATCH)])
    assert issues(history, 1, bodies=bodies) == issues(history, 3, bodies=bodies) == []


def test_a_changed_index_is_noticed_too(history):
    """A body that was hashed anew together with its index row passes the chain's own check of the body."""
    decision, segment = one(history, 3)
    index = history["index"].withColumn("this_snapshot_sha256", F.when(F.col("decision_id") == decision, F.lit("0")).otherwise(F.col("this_snapshot_sha256")))
    agree(history, 3, [("personal_finance", 3, segment, merkle.SEGMENT_ALTERED), ("personal_finance", 3, -1, merkle.ROOT_MISMATCH)], index=index)


def test_a_removed_body(history):
    decision, segment = one(history, 3)
    bodies = history["bodies"].where(F.col("decision_id") != decision)
    agree(history, 3, [("personal_finance", 3, segment, merkle.SEGMENT_ALTERED), ("personal_finance", 3, -1, merkle.ROOT_MISMATCH)], bodies=bodies)


def test_a_cut_off_tail_leaves_the_chain_whole_but_not_the_tree(history):
    last = history["index"].where("product = 'bnpl'").agg(F.max("segment")).head()[0]
    gone = (F.col("product") == "bnpl") & (F.col("segment") == last)
    ids = history["index"].where(gone).select("decision_id")
    index, bodies = history["index"].where(~gone), history["bodies"].join(ids, "decision_id", "left_anti")
    vectors = index.sparkSession.createDataFrame([], "sha256 string, json string, prefix string")
    assert audit.verify_chain(index, bodies, vectors).count() == 0
    agree(history, 3, [("bnpl", 3, last, merkle.SEGMENT_MISSING), ("bnpl", 3, -1, merkle.ROOT_MISMATCH)], index=index, bodies=bodies)


def test_a_batch_and_its_heads_taken_away(history):
    kept = {k: history[k].where("batch < 3") for k in history}
    assert issues(kept) == [] and issues(kept, last=2) == []
    assert issues(kept, last=3) == [("bnpl", 3, -1, merkle.HEAD_MISSING), ("personal_finance", 3, -1, merkle.HEAD_MISSING)]
    lost = history | {"heads": history["heads"].where("batch < 3")}
    assert {i[3] for i in issues(lost, 3)} == {merkle.HEAD_MISSING} and {i[3] for i in issues(lost)} == {merkle.ROOT_MISMATCH}


def test_rows_rewritten_with_all_their_hashes_need_the_key(history, spark):
    """Chain, leaves and heads made anew by someone without the key."""
    decision, _ = one(history, 3)
    index, bodies = (history[t].where(F.col("decision_id") != decision) for t in ("index", "bodies"))
    before = history["heads"].where("batch < 3")
    made = merkle.append(cut(merkle.leaves(index, bodies, 3)), merkle.latest_heads(before), b"guessed")
    leaves = history["leaves"].where("batch < 3").unionByName(made[0])
    changed = {"index": index, "bodies": bodies, "leaves": leaves, "heads": cut(before.unionByName(made[2]))}
    want = [("bnpl", 3, -1, merkle.FORGED_HEAD), ("personal_finance", 3, -1, merkle.FORGED_HEAD)]
    assert issues(history, **changed) == issues(history, 3, **changed) == want


def test_one_batch_is_verified_without_reading_the_others(history, spark):
    """Anything about other batches but the heads may be missing."""
    cutoff = {k: history[k].where("batch = 3") for k in ("index", "bodies", "leaves")} | {"heads": history["heads"].where("batch >= 2")}
    assert issues(history, 3, **cutoff) == []


def test_every_leaf_is_proven_and_no_other(history):
    proofs = cut(merkle.proofs(history["nodes"], history["leaves"].select("product", "at", "hash"), history["heads"]))
    count = history["leaves"].count()
    assert merkle.proven(proofs).where("holds").count() == proofs.count() == count
    assert proofs.agg(F.max(F.size("path"))).head()[0] <= 5
    for name, forged in (("hash", F.lit("0" * 64)), ("root", F.lit("0" * 64)), ("path", F.reverse("path"))):
        wrong = merkle.proven(proofs.where(F.size("path") > 1).withColumn(name, forged))
        assert wrong.where("holds").count() == 0


def test_index_and_bodies_meet_once(history):
    plan = merkle.leaves(history["index"], history["bodies"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1


def test_a_leaf_counts_its_rows_and_names_its_batch(history):
    index = history["index"].groupBy("product", "segment").agg(F.count("*").alias("rows"), F.max("batch").alias("batch"))
    found = merkle.leaves(history["index"], history["bodies"]).select("product", "segment", "rows", "batch")
    assert sorted(found.collect()) == sorted(index.collect())

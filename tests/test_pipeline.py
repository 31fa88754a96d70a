from __future__ import annotations

import json
from datetime import timedelta
from pathlib import Path

import pytest
from builders import one
from pyspark.sql import functions as F
from test_silver import FRAUD_ITEM, REPORT, document, profile_db

from lendspark import schemas
from lendspark.operators import bronze, quality
from lendspark.plans import pipeline
from lendspark.session import shared_dir
from lendspark.sources.files import read_table

EIDS = [f"784-1990-000000{i}-0" for i in range(1, 6)]


@pytest.fixture
def landing(tmp_path):
    root = tmp_path / "landing"
    for source in ("aecb", "fraud", "aml", "profile"):
        (root / source).mkdir(parents=True)
    for i, eid in enumerate(EIDS[:4]):
        text = document(REPORT.replace("784-1991-5550123-4", eid).replace(">A1<", f">A{i}<"))
        (root / "aecb" / f"{i}.xml").write_text(text)
    (root / "aecb" / "dup_0.xml").write_bytes((root / "aecb" / "0.xml").read_bytes())
    (root / "aecb" / "broken.xml").write_text("<open>")
    (root / "aecb" / "notes.txt").write_text("not a report")
    (root / "fraud" / "scores.json").write_text(json.dumps([FRAUD_ITEM | {"emirates_id": e, "provider_ref": e} for e in EIDS]))
    screening = {"full_name": "A B", "dob": "1990-01-01", "status": "CLEAR", "matched_lists": [], "received_at": "2026-04-19T00:00:00+00:00"}
    (root / "aml" / "callbacks.json").write_text(json.dumps([screening | {"emirates_id": e, "callback_id": e} for e in EIDS]))
    profile_db(str(root / "profile" / "profile.db"), [("a1", "u1"), ("a2", "u2")], [("i1", "a2", "OVERDUE")])
    return str(root)


def test_landing_twice_stores_once(spark, landing, tmp_path, as_of):
    store = str(tmp_path / "bronze")
    batch = bronze.land(spark, landing, store, "r1", as_of)
    summary = {r["source"]: (r["files_landed"], r["unique_hashes"]) for r in bronze.summary(batch).collect()}
    assert summary == {"aecb": (6, 5), "fraud": (1, 1), "aml": (1, 1), "profile": (1, 1)}
    bronze.land(spark, landing, store, "r2", as_of)
    assert bronze.read_bronze(spark, store).count() == 9
    bronze.land(spark, landing, store, "r3", as_of + timedelta(days=1))
    stored = bronze.read_bronze(spark, store)
    assert stored.count() == 18
    row = stored.where("source_event_id = 'dup_0'").orderBy("ingest_date").head()
    assert row["raw_path"] == f"bronze/aecb/ingest_date=2026-04-20/{row['content_sha256'][:16]}_dup_0.xml"
    assert (row["payload_format"], row["ingest_run_id"]) == ("xml", "r1")
    assert one(stored.where("source = 'profile'").select("payload_format").distinct())["payload_format"] == "sqlite"


def test_missing_folders_and_tables_read_as_empty(spark, tmp_path, as_of):
    batch = bronze.land(spark, str(tmp_path / "nowhere"), str(tmp_path / "bronze"), "r", as_of)
    assert batch.count() == 0
    assert read_table(spark, str(tmp_path / "none"), schemas.SILVER_AML).columns[0] == "callback_id"


def test_known_files_are_found_without_reading_their_content(spark, landing, tmp_path, as_of):
    store = str(tmp_path / "bronze")
    bronze.land(spark, landing, store, "r1", as_of)
    known = bronze.read_bronze(spark, store).select("source", "ingest_date", "raw_path")
    scan = known._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<raw_path:string>" in scan


def test_whole_run(spark, landing, tmp_path, as_of):
    root = str(tmp_path / "root")
    out = pipeline.run(spark, landing, root, as_of, "r1")
    counts = {name: out[name].count() for name in ("aecb", "fraud", "aml", "profile", "er_links", "er_quarantine", "fact_decision")}
    assert counts == {"aecb": 5, "fraud": 5, "aml": 5, "profile": 5, "er_links": 20, "er_quarantine": 0, "fact_decision": 15}
    rejects = read_table(spark, f"{root}/silver/rejects/aecb", "source string, reason string, raw string, raw_path string, source_event_id string, ingest_date string")
    assert one(rejects)["reason"] == "malformed XML"
    assert out["index"].count() == out["bodies"].count() == out["vectors"].count() == 15
    assert out["dq_result"].count() == len(quality.RULES)
    assert {r["product_id"] for r in out["dim_product"].collect()} == {r["product"] for r in out["fact_decision"].collect()}

    again = pipeline.run(spark, landing, root, as_of, "r1")
    assert again["index"].count() == 15
    later = pipeline.run(spark, landing, root, as_of + timedelta(hours=1), "r2", append_audit=True, use_er_links=True)
    assert later["index"].count() == 30
    assert later["index"].agg(F.countDistinct("batch")).head()[0] == 2


def test_line_delimited_feeds_land_and_parse_record_by_record(spark, landing, tmp_path, as_of):
    lines = [json.dumps(FRAUD_ITEM | {"emirates_id": EIDS[0], "provider_ref": f"line{i}"}) for i in range(50)]
    (Path(landing) / "fraud" / "more.jsonl").write_text("\n".join([*lines, "[1]", "{broken", ""]) + "\n")
    root = str(tmp_path / "root")
    for run_id in ("r1", "r2"):
        out = pipeline.run(spark, landing, root, as_of, run_id)
        assert out["fraud"].count() == 55
    stored = bronze.read_records(spark, f"{root}/bronze_records")
    assert stored.count() == 52 and stored.where(F.sha2("line", 256) != F.col("content_sha256")).count() == 0
    rejects = read_table(spark, f"{root}/silver/rejects/fraud", "source string, reason string, raw string, raw_path string, ingest_date string")
    assert rejects.count() == 2


def test_profiles_of_all_days_count_and_the_last_one_wins(spark, landing, tmp_path, as_of):
    root = str(tmp_path / "root")
    pipeline.run(spark, landing, root, as_of, "r1")
    moved = spark.createDataFrame(
        [("u1", EIDS[0], "New", "Name", "New Name", "1980-01-01", "+1", "n@x", "Ajman", "2024-01-01T00:00:00+00:00")], schemas.USERS
    )
    none = {"applications": spark.createDataFrame([], schemas.APPLICATIONS), "instalments": spark.createDataFrame([], schemas.INSTALMENTS)}
    second = pipeline.run(spark, landing, root, as_of + timedelta(days=1), "r2", profile={"users": moved} | none)
    assert second["profile"].count() == 6
    vectors = read_table(spark, f"{root}/gold/decision_input_vector", schemas.VECTOR)
    assert {r[0] for r in vectors.where(F.col("emirates_id") == EIDS[0]).select("full_name").collect()} == {"New Name"}
    third = pipeline.run(spark, landing, root, as_of + timedelta(days=2), "r3", profile={})
    assert third["profile"].count() == 6 and third["fact_decision"].count() == 15


def test_a_run_leaves_no_intermediate_tables(spark, landing, tmp_path, as_of):
    folder = Path(shared_dir(spark).removeprefix("file:")) / "lendspark"
    before = set(folder.glob("*"))
    out = pipeline.run(spark, landing, str(tmp_path / "root"), as_of, "r1")
    assert set(folder.glob("*")) == before
    assert out["decided"].count() == out["index"].count() == 15


def test_a_day_is_parsed_once(spark, landing, tmp_path, as_of):
    root = str(tmp_path / "root")
    pipeline.run(spark, landing, root, as_of, "r1")
    layout = pipeline.Layout(root)
    day = (as_of + timedelta(days=1)).date().isoformat()
    stored = bronze.read_bronze(spark, layout.path("bronze"))
    assert pipeline._pending(spark, stored, layout, day).where("source <> 'profile'").count() == 0
    again = pipeline._pending(spark, stored, layout, as_of.date().isoformat())
    assert again.where("source <> 'profile'").count() == 8


def test_a_breached_rule_blocks_gold(spark, landing, tmp_path, as_of):
    root = str(tmp_path / "root")
    with pytest.raises(quality.GateError, match="aecb_freshness_30d"):
        pipeline.run(spark, landing, root, as_of + timedelta(days=60), "r1")
    assert read_table(spark, f"{root}/gold/fact_decision", schemas.FACT_DECISION).count() == 0
    assert read_table(spark, f"{root}/gold/dq_result", schemas.DQ_RESULT).count() == len(quality.RULES)

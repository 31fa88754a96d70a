from __future__ import annotations

import json
import os
from datetime import timedelta
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from test_pipeline import EIDS, landing  # noqa: F401
from test_silver import FRAUD_ITEM

from lendspark.operators import bronze
from lendspark.plans import pipeline
from lendspark.streaming import landing as stream

IDENTITY = ("source", "source_event_id", "content_sha256", "raw_path", "payload_format", "ingest_run_id", "received_at", "ingest_date", "content")


def rows(df, *columns):
    return sorted(map(tuple, df.select(*(columns or IDENTITY)).collect()))


def add_report(landing, name, text="<open>"):  # noqa: F811
    (Path(landing) / "aecb" / name).write_text(text)


def test_the_stream_lands_what_the_batch_lands(spark, landing, tmp_path, as_of):  # noqa: F811
    once = bronze.land(spark, landing, str(tmp_path / "bronze"), "r1", as_of)
    assert rows(stream.land_files(spark, landing, str(tmp_path / "files"), "r1", as_of)) == rows(once)


def test_a_second_run_reads_only_new_files(spark, landing, tmp_path, as_of):  # noqa: F811
    store = str(tmp_path / "files")
    first = rows(stream.land_files(spark, landing, store, "r1", as_of))
    for path in Path(landing).rglob("*.xml"):
        path.write_text("changed after it was read")  # would show if an old file were opened again
    add_report(landing, "new1.xml")
    add_report(landing, "new2.xml")
    os.utime(Path(landing) / "aecb" / "new2.xml", (1, 1))  # as old as can be
    (Path(landing) / "later").mkdir()
    landed = stream.land_files(spark, landing, store, "r2", as_of + timedelta(days=1))
    assert rows(landed.where("ingest_run_id = 'r1'")) == first
    assert rows(landed.where("ingest_run_id = 'r2'"), "source_event_id", "ingest_date") == [("new1", "2026-04-21"), ("new2", "2026-04-21")]
    assert stream.land_files(spark, landing, store, "r3", as_of).where("ingest_run_id = 'r3'").count() == 0


def test_small_batches_land_everything_once(spark, landing, tmp_path, as_of):  # noqa: F811
    landed = stream.land_files(spark, landing, str(tmp_path / "files"), "r1", as_of, files_per_batch=2)
    assert landed.count() == 9 and landed.select(stream.BATCH).distinct().count() == 5


def test_a_killed_batch_is_repeated_without_doubles_and_keeps_its_day(spark, landing, tmp_path, as_of, monkeypatch):  # noqa: F811
    store, claim = str(tmp_path / "files"), stream._claim

    def land_half(spark, path, run_id, received_at):
        """Store some rows of the batch as the claimed run would, then die."""
        claimed = claim(spark, path, run_id, received_at)
        half = bronze.envelopes(bronze.scan_landing(spark, landing, "aecb"), "aecb", *claimed).limit(3).withColumn(stream.BATCH, F.lit(0))
        half.write.mode("append").partitionBy("source", "ingest_date", stream.BATCH).parquet(f"{store}/rows")
        raise RuntimeError("executor lost")

    monkeypatch.setattr(stream, "_claim", land_half)
    with pytest.raises(StreamingQueryException):
        stream.land_files(spark, landing, store, "r1", as_of)
    monkeypatch.setattr(stream, "_claim", claim)
    assert stream.read_landed(spark, store).count() == 3
    add_report(landing, "new.xml")
    landed = stream.land_files(spark, landing, store, "r2", as_of + timedelta(days=1))
    assert landed.count() == 10
    assert {tuple(r) for r in landed.groupBy("ingest_run_id", "ingest_date").count().collect()} == {("r1", "2026-04-20", 9), ("r2", "2026-04-21", 1)}


def test_archived_files_are_not_lost(spark, landing, tmp_path, as_of):  # noqa: F811
    store, archive = str(tmp_path / "files"), str(tmp_path / "archive")
    for run in range(3):
        add_report(landing, f"run{run}.xml")
        stream.land_files(spark, landing, store, f"r{run}", as_of, archive=archive)
    landed = stream.read_landed(spark, store)
    assert landed.count() == 12 and landed.where("source_event_id LIKE 'run%'").count() == 3


def test_no_landing_zone(spark, tmp_path, as_of):
    assert stream.land_files(spark, str(tmp_path / "nowhere"), str(tmp_path / "files"), "r", as_of).count() == 0
    assert stream.land_lines(spark, str(tmp_path / "nowhere"), str(tmp_path / "lines"), "r", as_of).count() == 0


def test_lines_land_once(spark, landing, tmp_path, as_of):  # noqa: F811
    feed, store = Path(landing) / "fraud" / "more.jsonl", str(tmp_path / "lines")
    feed.write_text("\n".join([*(json.dumps({"i": i}) for i in range(50)), "", "{broken"]) + "\n")
    (Path(landing) / "aecb" / "stray.jsonl").write_text("{}\n")
    assert stream.land_lines(spark, landing, store, "r1", as_of).count() == 51
    (Path(landing) / "aml" / "late.jsonl").write_text("{}\n")
    landed = stream.land_lines(spark, landing, store, "r2", as_of)
    assert rows(landed.where("ingest_run_id = 'r2'"), "source", "line") == [("aml", "{}")]
    assert landed.where(F.sha2("line", 256) != F.col("content_sha256")).count() == 0
    ordered = [r["line"] for r in landed.where("source = 'fraud'").orderBy("position").collect()]
    assert ordered[:50] == [json.dumps({"i": i}) for i in range(50)]


def test_whole_runs_over_two_days(spark, landing, tmp_path, as_of):  # noqa: F811
    root = str(tmp_path / "root")
    batch = pipeline.run(spark, landing, str(tmp_path / "other"), as_of, "r1")
    out = pipeline.run(spark, landing, root, as_of, "r1", incremental=True)
    wanted = ("aecb", "fraud", "aml", "profile", "er_links", "er_quarantine", "fact_decision", "index")
    assert {name: out[name].count() for name in wanted} == {name: batch[name].count() for name in wanted}
    more = FRAUD_ITEM | {"emirates_id": EIDS[0], "provider_ref": "late"}
    (Path(landing) / "fraud" / "late.json").write_text(json.dumps([more]))
    (Path(landing) / "fraud" / "late.jsonl").write_text(json.dumps(more | {"provider_ref": "line"}) + "\n")
    later = pipeline.run(spark, landing, root, as_of + timedelta(days=1), "r2", incremental=True, append_audit=True)
    assert {r["provider_ref"] for r in later["fraud"].collect()} == {*EIDS, "late", "line"}
    assert later["aecb"].count() == out["aecb"].count() and later["profile"].count() == 5

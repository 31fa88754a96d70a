from __future__ import annotations

from pathlib import Path

import pytest
from test_streaming_landing import landing, rows  # noqa: F401

from lendspark.operators import bronze
from lendspark.session import settings
from lendspark.sources.files import read_table, write_each
from lendspark.streaming import landing as stream


def reports(folder, n):
    for i in range(n):
        (Path(folder) / "aecb" / f"more{i}.xml").write_text(f"<report>{i}</report>")


def test_a_batch_of_small_files_is_stored_in_one_file_a_core(spark, landing, tmp_path, as_of):  # noqa: F811
    reports(landing, 91)
    store = tmp_path / "files"
    with settings(spark, {"spark.sql.files.maxPartitionBytes": "16m"}):
        landed = stream.land_files(spark, landing, str(store), "r1", as_of)
    assert rows(landed) == rows(bronze.land(spark, landing, str(tmp_path / "bronze"), "r1", as_of)) and landed.count() == 100
    for batch in (store / "rows").glob("source=*/ingest_date=*/landing_batch=0"):
        assert len(list(batch.glob("part-*"))) <= spark.sparkContext.defaultParallelism


def test_a_claim_takes_no_job_and_is_kept(spark, tmp_path, as_of):
    path = str(tmp_path / "claims" / "0")
    spark.sparkContext.setJobGroup("claim", "claim")
    try:
        assert stream._claim(spark, path, "r1", as_of) == ("r1", as_of)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("claim")
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert stream._claim(spark, path, "r2", as_of.replace(year=2027)) == ("r1", as_of)
    # one that Spark wrote, as earlier versions did
    older = str(tmp_path / "claims" / "1")
    read_table(spark, path, stream._CLAIM).write.parquet(older)
    assert stream._claim(spark, older, "r2", as_of.replace(year=2027)) == ("r1", as_of)
    # and one of which only the folder was made
    (tmp_path / "claims" / "2").mkdir()
    assert stream._claim(spark, str(tmp_path / "claims" / "2"), "r2", as_of) == ("r2", as_of)


def test_settings_hold_inside_the_block_only(spark):
    key = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(key)
    with pytest.raises(ValueError, match="out"), settings(spark, {key: "64KB"}):
        assert spark.conf.get(key) == "64KB"
        raise ValueError("out")
    assert spark.conf.get(key) == before


def test_every_text_is_a_file(spark, tmp_path):
    folder = str(tmp_path / "texts")
    texts = ["one", None, "", "ein\r\nzwei\n", "ä" * 5000, "one"]
    for _ in range(2):
        write_each(spark.createDataFrame([(t,) for t in texts], "value string").repartition(3), folder)
    write_each(spark.createDataFrame([], "value string"), folder)
    written = sorted(p.read_bytes() for p in Path(folder).iterdir())
    assert written == sorted([f"{t or ''}\n".encode() for t in texts] * 2)
    spark.createDataFrame([(t,) for t in texts], "value string").write.option("maxRecordsPerFile", 1).text(f"{folder}_spark")
    assert sorted({p.read_bytes() for p in Path(f"{folder}_spark").glob("part-*")}) == sorted(set(written))

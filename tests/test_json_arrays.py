from __future__ import annotations

import json
import os
import random
from pathlib import Path

import pytest

from lendspark.operators import bronze
from lendspark.plans import pipeline
from lendspark.sources import json_arrays
from lendspark.sources.files import scan_landing
from test_pipeline import EIDS, landing  # noqa: F401
from test_silver import FRAUD_ITEM

TRICKY = ['}', '{', '[', ']', ',', '"', '\\', '\\\\"', '},{', '"}],', "é", " ", "😀", "\n", "", " ", "a" * 40]


@pytest.fixture
def small_splits(spark, monkeypatch):
    """Files are cut every few hundred bytes, and chunks hold a few records."""
    monkeypatch.setattr(json_arrays, "CHUNK", 90)
    before = {key: spark.conf.get(key) for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def value(pick, depth=0):
    kind = pick.randrange(6 if depth < 3 else 3)
    if kind == 0:
        return pick.choice([None, True, 0, -1.5e10, 12])
    if kind <= 2:
        return "".join(pick.choice(TRICKY) for _ in range(pick.randrange(4)))
    if kind == 3:
        return [value(pick, depth + 1) for _ in range(pick.randrange(3))]
    return {"".join(pick.choice(TRICKY) for _ in range(2)): value(pick, depth + 1) for _ in range(pick.randrange(3))}


def write(folder, files):
    folder.mkdir(exist_ok=True)
    for name, text in files.items():
        (folder / name).write_bytes(text if isinstance(text, bytes) else text.encode())


def read(spark, folder):
    found = {}
    for row in json_arrays.scan_array_elements(spark, str(folder)).orderBy("name", "position").collect():
        found.setdefault(row["name"], []).append(row["line"])
    return found


def test_any_array_in_any_layout(spark, tmp_path, small_splits):
    pick, items, files = random.Random(3), {}, {}
    for i in range(4):
        items[f"{i}.json"] = [{"k": j, "v": value(pick)} for j in range(pick.randrange(1, 30))]
        layout = pick.choice([{"indent": 2}, {"separators": (",", ":")}, {}])
        text = json.dumps(items[f"{i}.json"], ensure_ascii=pick.random() < 0.5, **layout)
        files[f"{i}.json"] = b"\xef\xbb\xbf" * (i % 5 == 0) + (" \n" * (i % 3) + text + "\n" * (i % 4)).encode()
    write(tmp_path / "in", files)
    assert {name: [json.loads(line) for line in lines] for name, lines in read(spark, tmp_path / "in").items()} == items


def test_one_file_is_read_by_many_tasks(spark, tmp_path, small_splits):
    write(tmp_path / "in", {"one.json": json.dumps([{"k": i, "text": "}" * (i % 7)} for i in range(120)])})
    text = spark.read.option("lineSep", "}").text(str(tmp_path / "in" / "one.json"))
    assert text.rdd.getNumPartitions() > 8
    assert [json.loads(x)["k"] for x in read(spark, tmp_path / "in")["one.json"]] == list(range(120))


def test_a_record_longer_than_many_chunks(spark, tmp_path, small_splits):
    items = [{"a": 1}, {"long": [{"x": "}{" * 20}] * 20}, {"b": "y" * 2000}, {"c": 2}]
    write(tmp_path / "in", {"one.json": json.dumps(items)})
    assert [json.loads(x) for x in read(spark, tmp_path / "in")["one.json"]] == items


EDGES = [
    ("[]", None), (" [ \n ] \n", None), ("", None), ("  ", None), ("[1, \"}\", null]", ["1", ' "}"', " null"]),
    ('{"a": [1, 2]}', [None]), ('"[{}]"', [None]), ("no json, {at} all", [None]),
    ('[{"a": 1}, {"b": 2}', ['{"a": 1}', ' {"b": 2}']), ('[{"a": 1}, {"b": "x}, {"', ['{"a": 1}', ' {"b": "x}, {"']),
    ('[{"a": 1}]}', ['{"a": 1}', "}"]), ('[{"a": 1}', ['{"a": 1}']), ("\ufeff[2]", ["2"]), ("\ufeff[{}]}", ["{}", "}"]),
]


def test_edges(spark, tmp_path, small_splits):
    write(tmp_path / "in", {f"{i:02}.json": text for i, (text, _) in enumerate(EDGES)})
    found = read(spark, tmp_path / "in")
    assert [found.get(f"{i:02}.json") for i in range(len(EDGES))] == [lines for _, lines in EDGES]


def test_missing_folder_and_size(spark, tmp_path):
    assert json_arrays.scan_array_elements(spark, str(tmp_path / "none")).count() == 0
    write(tmp_path / "in", {"small.json": "[1]", "large.json": "[{},2222222222]", "other.txt": "[3]"})
    large = json_arrays.scan_array_elements(spark, str(tmp_path / "in"), larger_than=10)
    assert sorted((r["line"], r["name"], r["size"]) for r in large.collect()) == [("2222222222", "large.json", 15), ("{}", "large.json", 15)]


def test_large_arrays_land_and_parse_like_small_ones(spark, landing, tmp_path, as_of, monkeypatch):  # noqa: F811
    items = [FRAUD_ITEM | {"emirates_id": EIDS[0], "provider_ref": f"big{i}", "extra": {"t": "}]"}} for i in range(40)]
    (Path(landing) / "fraud" / "big.json").write_text(json.dumps([*items, 7, {"provider_ref": 1}]))
    size = os.path.getsize(Path(landing) / "fraud" / "big.json") - 1
    for module in ("lendspark.sources.files", "lendspark.operators.bronze"):
        monkeypatch.setattr(f"{module}.WHOLE_BYTES", size)
    monkeypatch.setattr(bronze.land_arrays, "__defaults__", (size,))
    monkeypatch.setattr(bronze.large_arrays, "__defaults__", (size,))
    assert scan_landing(spark, landing, "fraud").count() == 1
    root = str(tmp_path / "root")
    for run_id in ("r1", "r2"):
        out = pipeline.run(spark, landing, root, as_of, run_id)
        assert out["fraud"].count() == 45 and bronze.read_records(spark, f"{root}/bronze_records").count() == 42

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from lendspark.operators import content_store
from lendspark.session import cut


def rows(spark, numbers):
    table = [(hashlib.sha256(str(i).encode()).hexdigest(), f'{{"i":{i}}}') for i in numbers]
    df = spark.createDataFrame(table, "sha256 string, json string")
    return df.withColumn("prefix", F.substring("sha256", 1, 2))


def test_what_is_stored_is_always_possible_and_little_else(spark):
    stored, others = cut(rows(spark, range(5000))), cut(rows(spark, range(5000, 9000)))
    sketch = cut(content_store.sketch_of(stored))
    assert content_store.split_by_sketch(stored, sketch).where("NOT possible").count() == 0
    assert content_store.split_by_sketch(others, sketch).where("possible").count() < 40


def test_new_vectors_are_those_the_store_lacks(spark):
    stored, batch = rows(spark, range(300)), rows(spark, range(200, 500))
    halves = content_store.sketch_of(rows(spark, range(150))).unionByName(content_store.sketch_of(rows(spark, range(150, 300))))
    new = content_store.new_vectors(batch, stored, halves)
    assert sorted(r["json"] for r in new.collect()) == sorted(f'{{"i":{i}}}' for i in range(300, 500))
    assert new.columns == batch.columns


def test_a_crowded_sketch_costs_lookups_and_no_vector(spark):
    stored, batch = rows(spark, range(50)), rows(spark, range(40, 90))
    crowded = batch.select("prefix", content_store._block("sha256").alias("block"), F.lit(-1).cast("bigint").alias("bits"))
    sketch = content_store.sketch_of(stored).unionByName(crowded)
    assert content_store.split_by_sketch(batch, sketch).where("possible").count() == 50
    assert content_store.new_vectors(batch, stored, sketch).count() == 40


def test_empty_store_and_empty_batch(spark):
    none, batch = rows(spark, range(1)).limit(0), rows(spark, range(5))
    empty = content_store.sketch_of(none)
    assert content_store.new_vectors(batch, none, empty).count() == 5
    assert content_store.new_vectors(none, batch, content_store.sketch_of(batch)).count() == 0

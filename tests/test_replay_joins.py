from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from test_audit import decided

from lendspark.operators import audit
from lendspark.session import cut, settings


@pytest.fixture(scope="module")
def stored(spark, as_of):
    """As the catalog's queries have them: the vectors are worked out when they are read."""
    batch = cut(decided(spark, as_of, 20))
    return cut(audit.snapshot_bodies(audit.write_snapshots(batch, shards=2))), audit.vector_store_rows(audit.hashed_vectors(batch))


def joins(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("BroadcastHashJoin"), plan.count("SortMergeJoin")


def test_replay_never_broadcasts_the_vectors(spark, stored):
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "10MB"}):
        again = audit.replay(*stored)
        assert joins(again) == (0, 1)
        assert again.count() == 20 and again.where("NOT matches").count() == 0


def test_detail_never_broadcasts_the_vectors(spark, stored):
    bodies, vectors = stored
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "10MB"}):
        every = audit.decision_detail(bodies, vectors, F.col("decision_id"))
        assert joins(every) == (0, 3)
        assert every.where("matches AND sha2(vector, 256) = feature_vector_sha256").count() == 20
        one = bodies.orderBy("decision_id").head()
        shown = audit.decision_detail(bodies, vectors, one["decision_id"]).collect()
    assert [(r["decision_id"], r["matches"]) for r in shown] == [(one["decision_id"], True)]


def test_detail_of_a_decision_whose_vector_is_gone(stored):
    bodies, vectors = stored
    shown = audit.decision_detail(bodies, vectors.where("false"), F.col("decision_id"))
    assert shown.where("vector IS NULL AND matches IS NULL").count() == 20

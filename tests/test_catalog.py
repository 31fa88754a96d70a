from __future__ import annotations

import os

import pytest
from oracle_check import connect, difference

import __spark_entry__ as entry
from lendspark.catalog.oracles import ORACLES
from lendspark.catalog.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
# A query of every kind; `python tests/oracle_check.py sf0.01` compares all of them.
CHECKED = (
    "bronze_idempotent", "parse_bureau_xml", "validate_split", "profile_features", "jaro_winkler", "er_links",
    "conflict_log", "decision_vector", "decisions", "approval_rate", "dq_scorecard", "snapshots", "chain_verify",
    "chain_append_retry", "replay_sample", "decision_detail",
)

needs_data = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="given tables not present")


@needs_data
@pytest.mark.parametrize("name", CHECKED)
def test_same_as_duckdb(spark, name):
    assert difference(connect(SF_DIR), entry.queries()[name](spark, SF_DIR), entry.oracle_sql()[name]) is None


@needs_data
def test_entry(spark):
    assert entry.entry(spark).count() == 3


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())

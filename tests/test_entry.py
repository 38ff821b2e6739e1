from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from checks.compare import compare, duck

SF_DIR = "/root/testdata/sf0.001"

# One query per section by default; CONFLUO_ALL=1 runs every registered query.
DEFAULT = [
    "classify_records",
    "normalise_catalogue",
    "term_stats",
    "and_query",
    "proximity_query",
    "wildcard_query",
    "date_range_query",
    "fused_hits",
    "eval_interpolated",
    "er_three_sources",
]
NAMES = list(entry.queries()) if os.environ.get("CONFLUO_ALL") else DEFAULT

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, con, name):
    ok, note = compare(spark, con, SF_DIR, name, entry.queries()[name], entry.oracle_sql().get(name))
    assert ok, note


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.columns == ["query_id", "rank", "entity_id", "n_sources", "total_score"] and frame.count() > 0


def test_names_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries())

from __future__ import annotations

import os

import pytest

from checks.compare import compare, duck
from confluo.llm.queries import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, name):
    ok, note = compare(spark, duck(SF_DIR), SF_DIR, name, QUERIES[name], ORACLE.get(name))
    assert ok, note

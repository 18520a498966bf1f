"""Every query with SQL against DuckDB, on the driver's smallest tables."""

from __future__ import annotations

import os

import pytest

from compare import connect, differences
from touchline.llm.registry import ORACLES, QUERIES

SF_DIR = os.environ.get("TOUCHLINE_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    assert differences(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLES[name]) == []

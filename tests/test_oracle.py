"""Every registered job against its DuckDB oracle SQL on the driver's tables.

Runs at sf0.001 by default; set CAREBOOK_ORACLE_DIR=/root/testdata/sf0.01 for
the scale the driver's correctness gate uses.
"""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as se
from carebook.registry import JOBS
from tests.conftest import SMOKE_DIR
from tests.oracle_harness import compare, duck

SF_DIR = os.environ.get("CAREBOOK_ORACLE_DIR", SMOKE_DIR)


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_job_has_an_oracle():
    assert set(JOBS) <= set(se.oracle_sql()) and set(JOBS) <= set(se.queries())


@pytest.mark.parametrize("name", list(JOBS))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, SF_DIR, con)
    assert r["columns_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["values_match"], r
    assert r["types_match"], r


def test_entry_smoke(spark):
    df = se.entry(spark)
    rows = df.collect()
    assert df.columns == ["n_nationkey", "n_name", "event_type", "entries"]
    assert len(rows) > 0
    assert se.entry(spark).schema == df.schema

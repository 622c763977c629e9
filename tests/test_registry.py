"""Registered queries against their SQL twins at the smallest scale, and the rules they follow."""

from __future__ import annotations

import re
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as entry  # noqa: E402
import check  # noqa: E402

SF = Path("/root/testdata/sf0.001")
NAMES = sorted(entry.QUERIES)


@pytest.fixture(scope="module")
def con():
    made = duckdb.connect()
    for table in check.TABLES.split():
        made.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return made


def test_every_twin_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_names_carry_an_inventory_id():
    assert all(re.match(r"^[a-z]\d+_[a-z0-9_]+$", n) for n in NAMES)


@pytest.mark.skipif(not SF.exists(), reason="no test tables")
@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_twin(spark, con, name):
    ok, text = check.compare(spark, con, str(SF), name)
    assert ok, text


@pytest.mark.skipif(not SF.exists(), reason="no test tables")
def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0

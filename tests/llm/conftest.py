"""Small documents with every awkward case."""

from __future__ import annotations

import duckdb
import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names the operators use themselves.
CLASHING = ["size", "target", "name", "row", "node", "key", "shard", "slot", "ids", "n", "level", "component", "hashes", "u", "taken", "at"]

LONG = " ".join(f"word{i % 977} other{i}" for i in range(20_000))
AWKWARD = [
    (1, None, "en", "a", None),
    (2, "", None, "a", 0),
    (3, "   \n\t\n ", "en", None, 7),
    (4, "Same text here, copied often.\nSecond line of it", "en", "b", 46),
    (5, "Same text here, copied often.\nSecond line of it", "en", "a", 46),
    (5, "Same text here, copied often.\nSecond line of it", "en", "a", 46),
    (None, "Same text here, copied often.\nSecond line of it", "en", None, 46),
    (6, "  SAME TEXT here, copied often.  \nÉtude à part Ünïcode", "fr", "c", 57),
    (7, LONG, "en", "a", len(LONG)),
    (8, LONG + " tail", "en", "b", len(LONG) + 5),
    (9, "x" * 300_000, "de", "c", 300_000),
    (10, "one two", "de", "a", 7),
    (11, "12 34 !! ??", "de", "b", 11),
    (12, "Licensed under CC BY 4.0. Released under the MIT License.", "en", "c", 56),
    (None, None, None, None, None),
]


def frame(spark, rows, clashing=True):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    if clashing:
        from pyspark.sql import functions as F

        df = df.withColumns({c: F.lit(f"own {c}") for c in CLASHING})
    return df


@pytest.fixture
def awkward(spark):
    return frame(spark, AWKWARD)


@pytest.fixture
def empty(spark):
    return frame(spark, [])


@pytest.fixture(scope="session")
def small_sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small_texts(small_sf):
    return duckdb.sql(f"SELECT doc_id, text, lang, source FROM '{small_sf}/documents.parquet' ORDER BY doc_id").fetchall()


def clashing_kept(df):
    """Whether columns of the input that share names with the operator's came through unchanged."""
    row = df.first()
    return all(row[c] == f"own {c}" for c in CLASHING)

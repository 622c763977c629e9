from __future__ import annotations

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from clickloom.operators import ordering as O


def test_number_rows_counts_each_group_in_order(spark):
    random.seed(1)
    data = [("a" if random.random() < 0.7 else "b", random.randrange(50), i) for i in range(500)]
    random.shuffle(data)
    df = spark.createDataFrame(data, "g string, t int, id int").repartition(7)
    expected = []
    for g in "ab":
        ordered = sorted((t, i) for k, t, i in data if k == g)
        expected += [(g, t, i, n) for n, (t, i) in enumerate(ordered, 1)]
    assert rows(O.number_rows(df, ["g"], ["t", "id"]), "g", "t", "id", "rec_no") == sorted(expected)


def test_number_as_read_keeps_file_order(spark, tmp_path):
    lines = [f"v{i}" for i in range(200)]
    (tmp_path / "a.csv").write_text("c\n" + "\n".join(lines) + "\n")
    read = spark.read.option("header", True).csv(str(tmp_path / "a.csv"))
    assert rows(O.number_as_read(read, ["c"]), "row_no", "c") == [(i + 1, v) for i, v in enumerate(lines)]


@pytest.mark.parametrize("sizes", [(2, 5, 3), (1, 300, 40, 7), (50, 1, 1, 400)])
def test_number_as_read_follows_parts_of_unequal_size(spark, tmp_path, sizes):
    values, at = [], 0
    for i, n in enumerate(sizes):
        part = [f"v{at + j}" for j in range(n)]
        (tmp_path / f"part-{i}.csv").write_text("c\n" + "\n".join(part) + "\n")
        values += part
        at += n
    read = spark.read.option("header", True).csv(str(tmp_path))
    assert rows(O.number_as_read(read, ["c"]), "row_no", "c") == [(i + 1, v) for i, v in enumerate(values)]


def test_number_in_groups_across_runs(spark):
    data = [(f"k{i % 3}", i) for i in range(1, 400)]
    df = spark.createDataFrame(data, "k string, rec_no long")
    seen: dict[str, int] = {}
    expected = []
    for k, n in data:
        seen[k] = seen.get(k, 0) + 1
        expected.append((k, n, seen[k]))
    assert rows(O.number_in_groups(df, ["k"], run_rows=16), "k", "rec_no", "pos") == sorted(expected)


def test_first_row_takes_whole_row(spark):
    df = spark.createDataFrame([("a", 2, None), ("a", 1, "x"), ("b", 5, "y")], "k string, n int, v string")
    assert rows(O.first_row(["k"], [F.col("n")], df)) == [("a", 1, "x"), ("b", 5, "y")]

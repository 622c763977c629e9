from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.llm import vafile


def plain(rows, k=5, every=50):
    """Best k of each query row by comparing with all other rows."""
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(256 * x) for x in v)]
    out = []
    for at, (i, q) in enumerate(ok):
        if i % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for n, (j, v) in enumerate(ok) if n != at and len(v) == len(q))
            out += [(i, rank, j, max(-(2**63), min(2**63 - 1, -s))) for rank, (s, j) in enumerate(scores[:k], 1)]
    return sorted(out)


def got(spark, rows, every=50, partitions=3, kind="float", **how):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").withColumn("v", F.lit("own")).withColumn("row", F.lit(1))
    return sorted(tuple(r) for r in vafile.top_k(vafile.scaled(df.repartition(partitions)), every, **how).collect())


def random_rows(seed, n, d, values=None):
    r = np.random.default_rng(seed)
    return [(i, [float(np.float32(x)) for x in (r.choice(values, d) if values else r.normal(0, 0.2, d))]) for i in range(n)]


@pytest.mark.parametrize(("seed", "d", "values"), [(1, 16, None), (2, 3, [0.0, 0.25, -0.25]), (3, 1, None)])
def test_equals_comparing_all(spark, seed, d, values):
    rows = random_rows(seed, 600, d, values)
    assert got(spark, rows) == plain(rows)


def test_queries_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(vafile, "TILE", 7)
    monkeypatch.setattr(vafile, "DATA_BLOCK", 13)
    rows = random_rows(4, 300, 8)
    assert got(spark, rows, every=5, query_bytes=25 * 64) == plain(rows, every=5)


def test_queries_from_very_many_partitions(spark):
    rows = random_rows(11, 3000, 2)
    assert got(spark, rows, every=1000, partitions=400) == plain(rows, every=1000)


def test_large_components_stay(spark):
    rows = [(0, [1.0, 2.0]), (1, [70000.0, 1.0]), (2, [1.0, 1.0]), (50, [-70000.0, 3e38]), (51, [3e38, 3e38]), (52, [-3e38, 1.0]), (53, [1e20, -1e20]), (54, [1e20, -1.1e20])]
    assert got(spark, rows, k=3) == plain(rows, k=3)
    rows = [(i, [x * 1.7, -x]) for i, x in enumerate([1e9, -1e9, 2e15, -2e15, 1e200, -1e200, 3.5, 1e300, -7e299])]
    assert got(spark, rows, every=2, kind="double", k=2) == plain(rows, every=2, k=2)


def test_text_sorts_as_numbers_do():
    random.seed(1)
    numbers = [0, 1, -1, 9, 10, -9, -10] + [random.choice([-1, 1]) * random.randrange(10 ** random.randrange(1, 90)) for _ in range(500)]
    assert sorted(numbers) == sorted(numbers, key=vafile.ranked)


def test_awkward_vectors(spark):
    random.seed(5)
    rows = random_rows(6, 120, 4)
    rows += [(200, None), (250, []), (300, [1.0, None, 0.0, 0.0]), (350, [math.nan] * 4), (400, [math.inf, 0.0, 0.0, 0.0]), (450, [1e30, 0.0, 0.0, 0.0])]
    rows += [(None, [1.0, 1.0, 1.0, 1.0]), (500, [0.5, 0.5]), (501, [0.25, 1.0]), (550, [0.1] * 7)]
    rows += [(50, rows[50][1]), (50, [0.5, -0.5, 0.5, 1.0]), (7, rows[7][1]), (8, rows[7][1]), (600, [0.0] * 4), (650, [9000.0, -9000.0, 1.0, 1.0])]
    assert got(spark, rows) == plain(rows)
    assert got(spark, []) == []
    assert got(spark, [(0, [1.0, 2.0])]) == []


def test_large_groups_of_equal_vectors(spark):
    rows = [(i, [0.5, -0.25, 0.125]) for i in range(900)] + random_rows(8, 100, 3)
    rows = [(i, v) for i, (_, v) in enumerate(rows)]
    assert got(spark, rows) == plain(rows)


def cells_of(vectors):
    return vafile.Cells(vectors[:: max(1, len(vectors) // 1000)], vectors.min(axis=0), vectors.max(axis=0))


def test_bounds_enclose_scores():
    r = np.random.default_rng(9)
    vectors, queries = r.integers(-(2**23), 2**23, (200, 64)).astype(float), r.integers(-(2**23), 2**23, (20, 64)).astype(float)
    vectors[3, 5], vectors[4, 6] = 1e12, -1e12
    cells = vafile.Cells(vectors[:50], vectors.min(axis=0), vectors.max(axis=0))
    low, high = cells.corners(cells.codes(vectors))
    assert (low <= vectors).all() and (vectors <= high).all()
    lower, upper = vafile.QueryBlock(-1 - np.arange(20), queries).bounds(low, high, np.arange(200))
    exact = queries @ vectors.T
    assert (lower <= exact).all() and (exact <= upper).all()


def test_few_exact_vectors_are_read(spark, monkeypatch):
    """At 64 dimensions at most 5% of the vectors are noted for a query, and far fewer are fetched."""
    rows = random_rows(10, 2000, 64)
    fetched, fetch = [], vafile._fetched

    def counting(pairs, *more):
        fetched.append(pairs.count())
        return fetch(pairs, *more)

    monkeypatch.setattr(vafile, "_fetched", counting)
    assert got(spark, rows) == plain(rows)
    vectors = np.array([[math.floor(256 * x) for x in v] for _, v in rows], float)
    cells = cells_of(vectors)
    queries = vafile.QueryBlock(np.arange(0, 2000, 50), vectors[::50])
    lower, upper = queries.bounds(*cells.corners(cells.codes(vectors)), np.arange(2000))
    floors = np.sort(lower, axis=1)[:, -5]
    assert (upper >= floors[:, None]).mean() < 0.05
    assert len(fetched) == 2 and fetched[0] <= 40 * 20 and sum(fetched) < 0.02 * 40 * 2000

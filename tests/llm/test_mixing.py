from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from clickloom.llm import mixing
from tests.llm.conftest import clashing_kept, frame


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, cap=2):
    """Reshare the excess of capped sources by weight until none is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, left, open_ = {}, share * sum(sizes.values()), set(order)
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > cap * sizes[s]}
        if not over:
            return target | {s: left * weight[s] / total for s in open_}
        for s in over:
            target[s] = cap * sizes[s]
        left -= sum(target[s] for s in over)
        open_ -= over
    return target


@pytest.mark.parametrize("seed", range(4))
def test_targets_equal_repeated_resharing(spark, seed):
    random.seed(seed)
    sizes = {s: random.choice([0, 1, 10, 500, 10_000]) for s in ["a", "B", "é", "", "z", None, "aa"]}
    given = spark.createDataFrame([(s, n, float(n)) for s, n in sizes.items()], "source string, source_size long, weighted_size double")
    got = {r["source"]: r["target"] for r in mixing.source_targets(given).collect()}
    want = plain_targets(sizes)
    assert got.keys() == want.keys()
    assert all(got[s] == pytest.approx(want[s]) for s in want)


def documents(n=3000, seed=1):
    random.seed(seed)
    sources = ["hot"] * 10 + ["b", "c", "d", None]
    return [(i, " ".join(["w"] * max(0, int(random.lognormvariate(3, 1)))), "en", random.choice(sources), 0) for i in range(n)]


def test_words_near_targets_and_at_most_two_copies(spark):
    docs = frame(spark, documents())
    rows = mixing.mix(docs).select("source", "__mix.*").collect()
    for source in {r["source"] for r in rows}:
        own = [r for r in rows if r["source"] == source]
        taken = sum(r["copies"] * r["size"] for r in own)
        assert abs(taken - own[0]["target"]) <= max(r["size"] for r in own) / 2
        assert {r["copies"] for r in own} <= {0, 1, 2}
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, mixing.mix(docs).select("source", "__mix.*").collect()), key=str)


def test_heavier_documents_are_taken_more_often(spark):
    docs = frame(spark, [(i, "one two three four", "en", "s", 0) for i in range(2000)])
    rows = mixing.mix(docs, share=0.5, weight=F.when(F.col("doc_id") < 1000, 3.0).otherwise(1.0)).select("doc_id", "__mix.copies").collect()
    heavy = sum(c for i, c in rows if i < 1000)
    light = sum(c for i, c in rows if i >= 1000)
    assert abs(heavy + light - 1000) <= 1 and 2.3 < heavy / light < 4


def test_order_is_that_of_the_formula(spark):
    """The documents that get one copy more are the first of the ranking, up to the words left open."""
    rows = mixing.mix(frame(spark, documents(400, 2)), share=0.7).select("doc_id", "source", "__mix.*").collect()
    by_id = {r["doc_id"]: r for r in rows}
    u = {r[0]: r[1] for r in spark.createDataFrame([(i,) for i in by_id], "doc_id long").select("doc_id", mixing.uniform(F.col("doc_id"), mixing.SEED)).collect()}
    for source in {r["source"] for r in rows}:
        own = [r for r in rows if r["source"] == source]
        rate = own[0]["target"] / own[0]["source_size"]
        whole, p = int(rate), rate - int(rate)
        left, at = own[0]["target"] - whole * own[0]["source_size"], 0
        for r in sorted(own, key=lambda r: ((u[r["doc_id"]] / (1 - u[r["doc_id"]])) / (p / (1 - p)) if p else 0, str(r["doc_id"]))):
            more = p > 0 and 2 * at + r["size"] <= 2 * left
            assert r["copies"] == whole + more
            at += r["size"]


def test_awkward_rows(awkward, empty):
    rows = mixing.mix(awkward).select("doc_id", "source", "__mix.*").collect()
    assert len(rows) == awkward.count()
    assert all(r["size"] == 0 for r in rows if r["doc_id"] in (1, 2, 3))
    assert len({r["copies"] for r in rows if r["doc_id"] == 5}) == 1
    mixed = mixing.mixed(awkward)
    assert mixed.columns == awkward.columns and clashing_kept(mixed)
    assert mixed.count() == sum(r["copies"] for r in rows)
    assert mixing.mixed(empty).count() == 0


def test_no_words_at_all(spark):
    rows = mixing.mix(frame(spark, [(1, None, "en", "a", 0), (2, "", "en", None, 0)])).select("__mix.*").collect()
    assert [(r["size"], r["target"], r["copies"]) for r in rows] == [(0, 0.0, 0)] * 2

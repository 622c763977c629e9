from __future__ import annotations

import random
from collections import defaultdict

import pytest
from conftest import rows
from pyspark.sql import functions as F

from clickloom.functions import records as R
from clickloom.operators import detections as D, trains as T

SCHEMA = "pod_file string, minute_no long, train_id int, rec_no long, class_byte int, time_us long"


def clicks(seed=3, n=400):
    random.seed(seed)
    # One train holds most clicks.
    data = []
    for i in range(1, n + 1):
        train = 1 if random.random() < 0.6 else random.choice([2, 3])
        data.append(("a", 1 if i < 300 else 2, train, i, random.randrange(256), random.randrange(10**6)))
    return data


def by_train(data):
    groups = defaultdict(list)
    for f, m, t, i, c, us in sorted(data, key=lambda r: r[3]):
        groups[(f, m, t)].append((i, c, us))
    return groups


@pytest.mark.parametrize("run_rows", [4, 50, 10_000])
def test_train_facts_match_brute_force(spark, run_rows):
    data = clicks()
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    want = []
    for key, items in by_train(data).items():
        gaps = [b[2] - a[2] for a, b in zip(items, items[1:])]
        want.append((*key, items[0][1], len(items), items[0][2], items[-1][2], min(gaps) if gaps else None))
    got = rows(
        T.train_facts(df, run_rows=run_rows),
        "pod_file", "minute_no", "train_id", "class_byte", "no_of_clicks", "first_us", "last_us", "min_ici_us",
    )
    assert got == sorted(want)


@pytest.mark.parametrize("run_rows,segment", [(4, 10_000), (50, 7), (10_000, 1)])
def test_click_arrays_lose_nothing(spark, run_rows, segment):
    data = clicks()
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    got = T.click_arrays(df, ["time_us"], segment_clicks=segment, run_rows=run_rows)
    parts = defaultdict(list)
    for r in got.collect():
        assert len(r.time_us) <= segment
        parts[(r.pod_file, r.minute_no, r.train_id)].append(r)
    for key, items in by_train(data).items():
        pieces = sorted(parts[key], key=lambda r: r.segment_no)
        times = [i[2] for i in items]
        assert sum((p.time_us for p in pieces), []) == times
        assert sum((p.ici_us for p in pieces), []) == [b - a for a, b in zip(times, times[1:])]
        assert {p.no_of_clicks for p in pieces} == {len(items)} and {p.class_byte for p in pieces} == {items[0][1]}


def test_interval_may_be_negative(spark):
    df = spark.createDataFrame([("a", 1, 1, 1, 0, 500), ("a", 1, 1, 2, 0, 400)], SCHEMA)
    assert rows(T.with_interval(df), "rec_no", "ici_us") == [(1, None), (2, -100)]


def test_unknown_species_class_keeps_the_row(spark):
    df = spark.createDataFrame([(0x5B,), (0x0F,), (0xF0,)], "b int").select(
        *[v.alias(k) for k, v in R.cpod_class(F.col("b")).items()]
    )
    got = [tuple(r) for r in df.select("species", "quality", "rate_good", "species_good").collect()]
    assert got == [("Unknown", "High", 0, 1), ("NBHF", "High", 1, 1), ("Unknown", "Doubtful", 0, 0)]


def train(q, species=0, good=1, n=5, span=3000, gap=100, minute=1):
    return ("a", minute, q, q, species, good, n, 0, span, gap)


TRAIN_SCHEMA = (
    "pod_file string, minute_no long, train_id int, quality_class int, species_class int, species_good int, "
    "no_of_clicks long, first_us long, last_us long, min_ici_us long"
)


def test_species_good_counts_but_does_not_hide_train_time(spark):
    df = spark.createDataFrame([train(3, good=0), train(2), train(1, species=1)], TRAIN_SCHEMA)
    r = T.minute_counts(df, need_species_good=True).collect()[0]
    assert (r.clickHi, r.usHi, r.buzzHi) == (0, 3000, 1)
    assert (r.clickMed, r.usMed, r.clickLow, r.usLow) == (5, 3000, 0, 0)
    assert (r.no_of_trains, r.no_of_clicks) == (3, 15)


def test_output_has_three_rows_per_minute_with_zeros(spark):
    minutes = spark.sql(
        "SELECT 'a' pod_file, CAST(k AS BIGINT) minute_no, timestamp_ntz'2024-01-01 00:00:00' minute_start, "
        "2.5D temperature, 79.5D angle, CAST(IF(k = 2, NULL, 5000) AS BIGINT) nall FROM VALUES (1), (2) t(k)"
    )
    counts = T.minute_counts(spark.createDataFrame([train(3)], TRAIN_SCHEMA))
    out = D.output_rows(D.fill_empty_minutes(minutes, counts))
    assert tuple(out.columns) == D.OUTPUT_COLUMNS
    got = rows(out, "QUALITY", "NUMBER_CLICKS_FILTERED", "DPM", "MILLISECONDS", "BPM", "TIME_LOST_PERCENTAGE", "RECORDED")
    assert got == [("Hi", 0, 0, 0, 0, 0, 0), ("Hi", 5, 1, 3, 1, 1, 0)] + [
        (q, 0, 0, 0, 0, lost, 0) for q in ("Lo", "Mod") for lost in (0, 1)
    ]
    assert {tuple(r) for r in out.select("TEMPERATURE", "ANGLE").collect()} == {(3.0, 80.0)}


def test_rounding_is_away_from_zero(spark):
    r = spark.sql("SELECT round(2.5D) a, round(-2.5D) b, round(-0.4D) c").collect()[0]
    assert (r.a, r.b, r.c) == (3.0, -3.0, 0.0)

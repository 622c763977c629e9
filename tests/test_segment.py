from __future__ import annotations

import random

import pyarrow as pa
import pytest
from conftest import rows
from pyspark.sql import functions as F

from clickloom.operators import segment as G

SCHEMA = "pod_file string, rec_no long, rec_type int"


def stream(seed: int, n: int, hot: float = 0.15, end: int | None = None):
    random.seed(seed)
    kinds = [254 if random.random() < hot else random.choice([0, 1, 2, 100, 249]) for _ in range(n)]
    if end is not None:
        kinds[end] = 255
    return kinds


def table(spark, **files):
    data = [(name, i, k) for name, kinds in files.items() for i, k in enumerate(kinds, 1)]
    random.shuffle(data)
    return spark.createDataFrame(data, SCHEMA).repartition(5)


def expected_segments(kinds, stop=False):
    out, seg = [], 0
    for i, k in enumerate(kinds, 1):
        if stop and k == 255:
            break
        seg += k == 254
        out.append((i, k, seg))
    return out


@pytest.mark.parametrize("run_rows", [1, 7, 64, 100_000])
def test_segments_do_not_depend_on_run_size(spark, run_rows):
    files = {"a": stream(1, 300), "b": stream(2, 40, hot=0.02), "c": stream(3, 25, hot=0.9)}
    got = G.segment(table(spark, **files), run_rows=run_rows)
    want = sorted((f, i, k, s, len(kinds)) for f, kinds in files.items() for i, k, s in expected_segments(kinds))
    assert rows(got, "pod_file", "rec_no", "rec_type", "seg_no", "last_rec") == want


@pytest.mark.parametrize("run_rows", [5, 1000])
def test_positions_since_last_marker(spark, run_rows):
    kinds = stream(4, 400, hot=0.05)
    got = G.segment(table(spark, a=kinds), G.fpod_counters(), run_rows=run_rows).filter("seg_no >= 1")
    want, seg, t, c = [], 0, 0, 0
    for i, k in enumerate(kinds, 1):
        if k == 254:
            seg, t, c = seg + 1, 0, 0
        t += k == 249
        c += k <= 183
        if seg:
            want.append((i, seg, t, c))
    assert rows(got, "rec_no", "seg_no", "pos_train", "pos_click") == want


@pytest.mark.parametrize("run_rows", [6, 1000])
def test_offsets_from_boundaries_equal_own_totals(spark, run_rows):
    files = {"a": stream(5, 200, end=150), "b": stream(6, 90), "c": [1, 2, 3]}
    df = table(spark, **files)
    ends = df.groupBy("pod_file").agg(F.max("rec_no").alias("last_rec"))
    offsets = G.run_offsets(G.boundaries(df), ends, run_rows)
    columns = ("pod_file", "rec_no", "seg_no", "last_rec")
    once = rows(G.segment(df, offsets=offsets, stop_at_end=True, run_rows=run_rows), *columns)
    assert once == rows(G.segment(df, stop_at_end=True, run_rows=run_rows), *columns)
    last = {"a": 150, "b": 90, "c": 3}
    want = sorted((f, i, s, last[f]) for f, kinds in files.items() for i, _, s in expected_segments(kinds, stop=True))
    assert once == want


def test_end_mark_truncates_only_its_file(spark):
    df = table(spark, a=[254, 1, 255, 254, 2], b=[254, 1, 2])
    got = G.segment(df, stop_at_end=True)
    assert rows(got, "pod_file", "rec_no") == [("a", 1), ("a", 2), ("b", 1), ("b", 2), ("b", 3)]


def test_clicks_before_first_marker_and_last_record_are_dropped(spark):
    df = table(spark, a=[7, 254, 8, 254, 9, 10])
    got = G.cpod_clicks(G.segment(df))
    # 9 follows the last marker; it stays here and falls away where no minute row exists.
    assert rows(got, "train_id", "minute_no") == [(8, 2), (9, 3)]


def test_minutes_shift_attributes_and_add_a_tail(spark):
    marks = spark.createDataFrame(
        [("a", 1, 50, 0, 0), ("a", 2, 60, 128, 3)], "pod_file string, marker_no long, b4 int, b5 int, b9 int"
    )
    for tail, n in ((False, 2), (True, 3)):
        files = spark.createDataFrame([("a", 2, tail)], "pod_file string, n_markers long, has_tail boolean")
        got = rows(G.cpod_minute_rows(marks, files), "minute_no", "temperature", "angle")
        assert [(k, t, round(x, 6)) for k, t, x in got] == [(1, 0.0, 0.0), (2, 10.0, 0.0), (3, 12.0, 90.0)][:n]


def test_tail_needs_a_raw_twin_with_more_markers(spark):
    three = G.markers(G.segment(table(spark, a=[254, 1, 254], b=[254], c=[254])))
    one = G.markers(G.segment(table(spark, a=[254, 254, 254], b=[254], d=[254])))
    got = rows(G.tail_files(three, one), "pod_file", "n_markers", "n_cp1", "has_tail")
    assert got == [("a", 2, 3, True), ("b", 1, 1, False), ("c", 1, None, False), ("d", 0, 1, True)]


@pytest.mark.parametrize("run_rows", [3, 1000])
def test_cp1_totals_ignore_end_marks(spark, run_rows):
    kinds = [5, 254, 0, 255, 0, 254, 254, 0, 0, 255]
    df = table(spark, a=kinds)
    ends = spark.createDataFrame([("a", len(kinds))], "pod_file string, last_rec long")
    got = G.cp1_click_totals(G.boundaries(df), ends, run_rows)
    assert rows(got, "minute_no", "nall") == [(1, 2), (2, 0), (3, 2)]


def test_minute_on_flag(spark):
    data = [(1, 50, 1), (2, 50, 0), (3, 200, 0), (4, 200, 2), (5, 2, 0)]
    df = spark.createDataFrame(data, "minute_no long, tilt int, raw_clicks int").withColumns(
        {"tilt_min": F.lit(8), "tilt_max": F.lit(100)}
    )
    assert rows(G.with_minute_on(df), "minute_no", "minute_on") == [(1, 0), (2, 1), (3, 0), (4, 1), (5, 0)]


def test_zip_by_position_keeps_train_records_without_click(spark):
    df = table(spark, a=[254, 249, 249, 100, 254, 100, 249]).withColumns(
        {"b15": F.col("rec_no").cast("int"), "b16": F.lit(1), "time_us": F.col("rec_no") * 10}
    )
    cut = G.segment(df, G.fpod_counters())
    columns = ("minute_no", "pos", "class_byte", "time_us")
    assert rows(G.zip_by_position(cut), *columns) == [(1, 1, 2, 40), (1, 2, 3, None), (2, 1, 7, 60)]
    assert rows(G.zip_by_position(cut, need_click=True), *columns) == [(1, 1, 2, 40), (2, 1, 7, 60)]


def test_read_records_are_never_broadcast(spark):
    """The rows of a reader in Python are estimated by its input, here three short rows, however many it returns."""

    def read(batches):
        for batch in batches:
            for name in batch.column(0).to_pylist():
                n = 50_000
                kinds = pa.array([254 if i % 100 == 0 else 1 for i in range(n)], pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array([name] * n), pa.array(range(1, n + 1), pa.int64()), kinds], ["pod_file", "rec_no", "rec_type"])

    listed = spark.createDataFrame([("a",), ("b",), ("c",)], "pod_file string").repartition(2)
    cut = G.segment(listed.mapInArrow(read, SCHEMA), stop_at_end=True, run_rows=1000).select("pod_file", "rec_no")
    assert len(cut.collect()) == 150_000
    assert "BroadcastExchange" not in cut._jdf.queryExecution().executedPlan().toString()

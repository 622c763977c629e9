"""Detector files written from tables: their bytes, and the memory of the workers that write them."""

from __future__ import annotations

import os
from itertools import pairwise
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from clickloom.layout import LAYOUTS
from workload import bytefiles as B

RECORDS = 1_000_000


def records(spark, n, name="A"):
    """A recording in no order: a marker every 1,000 records, clicks between."""
    click = F.col("id") % 1000 != 0
    none = F.lit(None).cast("int")
    return spark.range(n).select(
        F.lit(name).alias("pod_file"), (F.lit(n) - F.col("id")).alias("rec_no"), F.when(click, 1).otherwise(254).alias("rec_type"),
        F.when(click, none).otherwise((F.col("id") % 7).cast("int")).alias("b4"), F.when(click, F.col("id") * 5).alias("time_us"),
        *[none.alias(f"b{i}") for i in (5, 8, 9, 10)],
    )


def workers():
    """Python workers and their daemons below this process."""
    found, level = [], [os.getpid()]
    while level:
        level = [int(c) for p in level for t in Path(f"/proc/{p}/task").glob("*/children") for c in t.read_text().split()]
        found += [p for p in level if b"pyspark.daemon" in Path(f"/proc/{p}/cmdline").read_bytes()]
    return found


def mb(pid, what):
    status = Path(f"/proc/{pid}/status").read_text()
    return int(status.split(f"{what}:")[1].split()[0]) / 1024


@pytest.mark.skipif(not Path("/proc/self/clear_refs").exists(), reason="peaks are read from /proc")
@pytest.mark.parametrize("kind", ["CP1", "FP3"])
def test_a_long_recording_does_not_fill_a_worker(spark, tmp_path, kind):
    B._write_files(records(spark, 1000), kind, f"{tmp_path}/short")
    before = {}
    for pid in workers():
        Path(f"/proc/{pid}/clear_refs").write_text("5")  # the peak starts anew
        before[pid] = mb(pid, "VmRSS")
    assert before
    assert B._write_files(records(spark, RECORDS), kind, f"{tmp_path}/long") == 1
    layout, more = LAYOUTS[kind], 2 if kind == "CP1" else 1
    assert os.path.getsize(f"{tmp_path}/long/A.{kind}") == layout.header_bytes + (RECORDS + more) * layout.record_bytes
    grown = [mb(pid, "VmHWM") - before.get(pid, max(before.values())) for pid in workers()]
    assert max(grown) < 60, grown


@pytest.mark.parametrize("kind", ["CP1", "CP3", "FP1", "FP3"])
@pytest.mark.parametrize("cuts", [[0, 7], [0, 1, 7], [0, 3, 7], [0, 4, 7], [0, 2, 3, 4, 6, 7]])
def test_pieces_make_the_bytes_of_the_whole(kind, cuts):
    rows = pd.DataFrame({
        "pod_file": "A", "rec_type": [254, 1, 0, 254, 1, 1, 254], "b4": [3, None, None, 4, None, None, 5],
        "time_us": [None, 5, 700_000, None, 10, 25, None],
    })
    layout = LAYOUTS[kind]
    head, body = B._header(kind), B._body(kind, rows).tobytes()
    mark, size = b"\xff" * layout.record_bytes, layout.record_bytes
    whole = {"CP1": body[: 3 * size] + mark + body[3 * size :] + mark, "CP3": body + mark + body[:size]}.get(kind, body + mark)
    pieces = [rows.iloc[a:b] for a, b in pairwise(cuts)]
    assert b"".join(B._file_bytes(kind, iter(pieces), len(rows))) == head + whole


def test_files_that_share_tasks_and_batches_stay_apart(spark, tmp_path):
    sizes = {f"F{i}": n for i, n in enumerate((1, 2, 3, 999, 2500, 10, 1))}
    both = None
    for name, n in sizes.items():
        both = records(spark, n, name) if both is None else both.unionByName(records(spark, n, name))
    limit = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        assert B._write_files(both, "CP1", str(tmp_path)) == len(sizes)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", limit)
    assert sorted(p.name for p in tmp_path.iterdir()) == sorted(f"{name}.CP1" for name in sizes)
    for name, n in sizes.items():
        data = (tmp_path / f"{name}.CP1").read_bytes()[LAYOUTS["CP1"].header_bytes :]
        kinds = np.frombuffer(data, np.uint8).reshape(-1, 10)[:, 9]
        ids = [n - rec_no for rec_no in range(1, n + 1)]
        expected = [254 if i % 1000 == 0 else 1 for i in ids]
        assert kinds.tolist() == [*expected[: n // 2], 255, *expected[n // 2 :], 255]

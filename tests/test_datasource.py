"""Detector files through ``spark.read.format``."""

from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, In, IsNull, LessThan, StringStartsWith
from test_detector_files import record

from clickloom.layout import LAYOUTS
from clickloom.sources import datasource as DS, records as Q

HEADER = LAYOUTS["CP3"].header_bytes


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    base = tmp_path_factory.mktemp("detector files")
    (base / "sub").mkdir()
    for k, name in enumerate(["a 1.CP3", "b 2.CP3", "sub/c.cp3", "empty.CP3"]):
        body = [record(40, b40=254 if i % 5 == 0 else (255 if i == 47 else i % 8), b4=i % 256, b37=k) for i in range(0 if "empty" in name else 50)]
        (base / name).write_bytes(bytes(HEADER) + b"".join(body) + b"xy")
    (base / "a 1.CP1").write_bytes(bytes(400))
    return base


def listed(spark, base):
    data = [(p.stem, str(p), p.stat().st_size) for p in sorted(base.rglob("*")) if p.suffix.upper() == ".CP3"]
    return spark.createDataFrame(data, "pod_file string, path string, bytes long")


def read(spark, base, columns="pod_file string, rec_no long, rec_type int, b4 int, b37 int, error string", **options):
    reader = DS.register(spark).read.format("detector_records").schema(columns).option("kind", "CP3")
    return reader.options(**options).load(str(base))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_are_those_of_the_record_reader(spark, folder):
    want = Q.read_records(listed(spark, folder), "CP3", (4, 37))
    for split_bytes in (40 * 7, 1 << 20):
        assert rows(read(spark, folder, split_bytes=split_bytes)) == rows(want)
        assert rows(DS.scan(listed(spark, folder), "CP3", (4, 37), split_bytes)) == rows(want)
    assert DS.register(spark).read.format("detector_records").option("kind", "cp3").load(str(folder)).columns == [
        "pod_file", "rec_no", "rec_type", *[f"b{i}" for i in range(1, 41)], "error"
    ]


FILTERS = [
    "rec_type = 254", "rec_type IN (254, 255)", "rec_type < 3 AND b4 > 9", "b37 = 1 AND rec_no >= 20 AND rec_no < 31",
    "pod_file = 'b 2'", "pod_file IN ('c', 'gone')", "pod_file LIKE 'a%' AND rec_no IN (3, 44)", "rec_no > 9000", "rec_no = -4",
    "rec_type = 254 OR b4 = 7", "NOT rec_type = 254 AND error IS NULL", "rec_type IS NULL", "b4 + 1 = 8",
]


@pytest.mark.parametrize("wanted", FILTERS)
def test_filters_give_the_same_rows(spark, folder, wanted):
    want = Q.read_records(listed(spark, folder), "CP3", (4, 37)).filter(wanted)
    for pushdown in (False, True):
        if pushdown or "error" in wanted or "NULL" not in wanted:
            assert rows(read(spark, folder, split_bytes=40 * 7, pushdown=pushdown).filter(wanted)) == rows(want)


def test_one_frame_used_twice(spark, folder):
    """Without pushdown a frame may be used with several filters; with it each use needs its own."""
    once = read(spark, folder)
    pairs = lambda a, b: a.filter("rec_type = 254").join(b.filter("rec_type = 3"), ["pod_file", "rec_no"], "full_outer").count()
    want = once.filter("rec_type IN (254, 3)").count()
    assert want > 0 and pairs(once, once) == want
    assert pairs(read(spark, folder, pushdown=True), read(spark, folder, pushdown=True)) == want


def test_filters_are_pushed(spark, folder):
    tested_again = lambda df: [line for line in plan(df).splitlines() if "Filter (" in line or "Filter isnotnull" in line]
    df = read(spark, folder, pushdown=True)
    assert tested_again(read(spark, folder).filter("rec_type = 254"))
    assert not tested_again(df.filter("rec_type = 254 AND rec_no >= 20 AND pod_file LIKE 'a%' AND b4 IN (1, 2)"))
    assert tested_again(df.filter("rec_type = 254 OR b4 = 7"))
    reader = DS.RecordReader("CP3", ["pod_file", "rec_type"], {"path": "x", "pushdown": "true"})
    taken = [EqualTo(("rec_type",), 254), In(("b4",), (1, 2)), LessThan(("rec_no",), 9), StringStartsWith(("pod_file",), "a"), IsNull(("error",))]
    left = [StringStartsWith(("error",), "x"), IsNull(("b4",))]
    assert list(reader.pushFilters([*taken, *left])) == left
    assert reader.wanted.records == taken[:3] and reader.wanted.names == [taken[3]] and reader.wanted.without_errors


def test_only_ranges_that_can_hold_rows_are_read(spark, folder):
    tasks = lambda df: df.rdd.getNumPartitions()
    load = lambda: read(spark, folder, split_bytes=40 * 7, pushdown=True)
    whole = load()
    assert tasks(whole) == 3 * 8 + 1
    assert tasks(load().filter("pod_file = 'c'")) == 8
    assert tasks(load().filter("pod_file = 'c' AND rec_no BETWEEN 15 AND 21")) == 1
    assert tasks(load().filter("pod_file = 'c' AND rec_no = 22")) == 1
    assert load().filter("pod_file = 'c' AND rec_no BETWEEN 15 AND 21").count() == 7


def test_failed_ranges_are_rows_and_never_vanish(spark, folder):
    files = listed(spark, folder).withColumn("bytes", F.col("bytes") + F.when(F.col("pod_file") == "c", 4000).otherwise(0))
    gone = spark.createDataFrame([("gone", str(folder / "gone.CP3"), 5000)], files.schema)
    load = lambda: DS.scan(files.unionByName(gone), "CP3", pushdown=True)
    bad = load().filter("error IS NOT NULL")
    assert [(r[0], "ends inside" in r[1] or "FileNotFound" in r[1]) for r in rows(bad.select("pod_file", "error"))] == [("c", True), ("gone", True)]
    assert load().filter("error IS NULL").count() == 100
    assert load().filter("error IS NULL AND rec_type = 254").count() == 20
    with pytest.raises(Exception, match="ends inside|FileNotFound"):
        load().filter("rec_type = 254").count()
    with pytest.raises(Exception, match="ends inside|FileNotFound"):
        load().select("pod_file").filter("rec_no > 3").count()


def test_wrong_options_are_told(spark, folder):
    with pytest.raises(Exception, match="option kind"):
        DS.register(spark).read.format("detector_records").load(str(folder)).count()
    with pytest.raises(Exception, match="no such columns"):
        read(spark, folder, "pod_file string, b41 int").count()
    with pytest.raises(Exception, match="path and files"):
        read(spark, folder, files="x").count()

"""Files listed by tasks."""

from __future__ import annotations

import os

import pytest
from conftest import rows
from pyspark.sql import DataFrame

from clickloom.sources import files as I, listing


@pytest.fixture()
def tree(tmp_path):
    names = ["a.CP3", "b.cp1", "c.txt", "d.FP3.bak", "one/e.FP1", "one/two three/f #1 %41.CP3", "one/_hidden/g.CP3", "one/.h/i.CP3", "_x.CP3", "empty/k.t"]
    for i, name in enumerate(names):
        path = tmp_path / "some files" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"x" * i)
        os.utime(path, ns=(0, 1_600_000_000_123_000_000 + i))
    return tmp_path / "some files"


def by_index(spark, root):
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", I.NAME_GLOB)
    return files.load(str(root)).select("path", "length", "modificationTime")


@pytest.mark.parametrize("form", ["{}", "file:{}", "{}/"])
def test_equals_the_file_index(spark, tree, form):
    got = I.detector_files(spark, form.format(tree))
    # Spark leaves out files without a byte; here they stay, to be reported as failed.
    assert rows(got.filter("length > 0")) == rows(by_index(spark, tree)) and got.count() == 4
    assert dict(got.dtypes) == dict(by_index(spark, tree).dtypes)


def test_the_driver_learns_only_counts(spark, tree, monkeypatch):
    def refused(*_, **__):
        raise AssertionError("statuses go to the driver")

    counts = []
    count = DataFrame.count
    cls = type(spark.range(1))
    count = cls.count
    monkeypatch.setattr(cls, "count", lambda df: counts.append(count(df)) or counts[-1])
    for name in ("collect", "toPandas", "toLocalIterator", "take", "head", "first", "toArrow"):
        monkeypatch.setattr(cls, name, refused)
    found = listing.list_files(spark, str(tree), I.NAME_PATTERN)
    monkeypatch.undo()
    assert counts == [2, 1, 0] and found.count() == 4


def test_empty_and_missing_folders(spark, tmp_path):
    assert I.list_pod_files(spark, str(tmp_path)).count() == 0
    with pytest.raises(Exception, match="FileNotFound|does not exist"):
        I.list_pod_files(spark, str(tmp_path / "gone")).count()


def test_other_file_systems_are_left_to_the_file_index():
    assert listing.can_list("/a") and listing.can_list("s3a://b/c") and not listing.can_list("strange://b/c")
    assert listing.lead_of("s3://bucket/x", "bucket/x") == "s3://" and listing.lead_of("/x", "/x") == "file:"

"""Sets of tables appear whole, and a run that died goes on where it was."""

from __future__ import annotations

import os

import pytest
from conftest import rows
from test_run import folder  # noqa: F401

from clickloom.plans import harmonise as H, outputs as O
from clickloom.session import exists, new_folder, scratch, shared_folder, step


def tables(spark, n):
    made = {k: spark.createDataFrame([(n, k, f"{k}/{i}") for i in range(n)], "n long, part string, v string") for k in ("one", "two", "three")}
    return made | {"empty": made["one"].limit(0)}


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_the_newest_set_is_read(spark, tmp_path, fmt):
    out = str(tmp_path / "out")
    assert O.published(spark, out) == {}
    for n in (2, 3):
        O.publish(spark, out, tables(spark, n), fmt, by={"two": "part"})
    got = O.published(spark, out)
    assert {k: rows(t, "n", "part", "v") for k, t in got.items()} == {k: rows(t, "n", "part", "v") for k, t in tables(spark, 3).items()}
    assert O.tidy(spark, out) == 1 and O.tidy(spark, out) == 0
    assert rows(O.published(spark, out)["two"], "n") == [(3,)] * 3


@pytest.mark.parametrize("fails", ["one", "two", "three"])
def test_a_run_that_breaks_between_two_tables_leaves_the_old_set(spark, tmp_path, monkeypatch, fails):
    out = str(tmp_path / "out")
    O.publish(spark, out, tables(spark, 2))
    before = {k: rows(t) for k, t in O.published(spark, out).items()}
    write = O.write_table

    def broken(df, path, fmt):
        if path.endswith(fails):
            raise OSError("the disk is full")
        return write(df, path, fmt)

    monkeypatch.setattr(O, "write_table", broken)
    with pytest.raises(OSError, match="full"):
        O.publish(spark, out, tables(spark, 5))
    assert {k: rows(t) for k, t in O.published(spark, out).items()} == before
    monkeypatch.undo()
    O.publish(spark, out, tables(spark, 6))
    assert rows(O.published(spark, out)["one"], "n") == [(6,)] * 6
    assert O.tidy(spark, out) == 2


def test_a_half_written_manifest_is_not_seen(spark, tmp_path):
    out = str(tmp_path / "out")
    O.publish(spark, out, tables(spark, 2))
    (tmp_path / "out" / O.MANIFESTS / "draft-1").write_text('{"run": ')
    assert rows(O.published(spark, out)["one"], "n") == [(2,)] * 2


def test_steps_are_made_once(spark):
    made = []

    def table(n):
        made.append(n)
        return spark.createDataFrame([(n,)], "n long")

    def start(fails):
        with scratch(spark, "steps", "key"):
            first = step(spark, "first", lambda: table(1))
            if fails:
                raise RuntimeError("dies")
            return rows(first) + rows(step(spark, "second", lambda: table(2)))

    for _ in range(2):
        with pytest.raises(RuntimeError, match="dies"):
            start(True)
    assert made == [1]
    assert start(False) == [(1,), (2,)] and made == [1, 2]
    assert not exists(spark, f"{shared_folder(spark)}/clickloom/steps-key")
    assert rows(step(spark, "first", lambda: table(3))) == [(3,)]


def test_a_half_written_step_is_made_again(spark):
    with pytest.raises(RuntimeError):
        with scratch(spark, "steps", "half") as run:
            step(spark, "a", lambda: spark.range(3).toDF("n"))
            raise RuntimeError
    path = spark._jvm.java.io.File(f"{run.removeprefix('file:')}/steps/a/_SUCCESS")
    assert path.delete()
    with scratch(spark, "steps", "half"):
        assert step(spark, "a", lambda: spark.range(5).toDF("n")).count() == 5
        with pytest.raises(ValueError, match="one step"):
            step(spark, "a", lambda: spark.range(5).toDF("n"))


def test_a_second_start_opens_no_detector_file_again(spark, folder, monkeypatch):  # noqa: F811
    base = folder[0]
    arguments = (spark, str(base / "files"), str(base / "sheet.csv"))
    want = {k: rows(t) for k, t in H.run(*arguments, new_folder(spark, "out"), project="p1").items()}
    out = new_folder(spark, "out")
    clip = H.D.clip

    def dies(*_):
        raise RuntimeError("killed after the read")

    with monkeypatch.context() as patch:
        patch.setattr(H.D, "clip", dies)
        with pytest.raises(RuntimeError, match="killed"):
            H.run(*arguments, out, project="p1")
    assert H.D.clip is clip and O.published(spark, out) == {}
    # The records are gone now; sizes and times are the same, so it is the same input.
    for path in (base / "files").rglob("*.*P*"):
        stat = path.stat()
        path.write_bytes(b"\xff" * stat.st_size)
        os.utime(path, ns=(stat.st_atime_ns, stat.st_mtime_ns))
    got = H.run(*arguments, out, project="p1")
    assert {k: rows(t) for k, t in got.items()} == want
    assert {k: rows(t) for k, t in O.published(spark, out).items()} == want

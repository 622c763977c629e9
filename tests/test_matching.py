from __future__ import annotations

import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from clickloom.operators import matching as M

DEPLOYMENTS = (
    "row_no long, RECEIVER string, STATION_NAME string, ACTIVATION_DATE_TIME timestamp_ntz, "
    "DEPLOY_DATE_TIME timestamp_ntz, VALID_DATA_UNTIL_DATE_TIME timestamp_ntz"
)


def day(n):
    return dt.datetime(2022, 1, 1, 13) + dt.timedelta(days=n)


def deployments(spark, *rows_):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows_, 1)], DEPLOYMENTS)


def files(spark, *names):
    data = [(i, f"/d/{n}", n, 10) for i, n in enumerate(names)]
    return spark.createDataFrame(data, "sel_no long, path string, name_ext string, bytes long")


def name(n, pod="POD912", ext="CP3", station="S"):
    return f"{station} {day(n):%Y %m %d} {pod} file01.{ext}"


def pairs(spark, names, deps, **options):
    return rows(M.match_pairs(M.match_index(files(spark, *names), deployments(spark, *deps), **options)), "row_no", "sel_no")


def test_day_range(spark):
    dep = ("C-POD-912", "S", day(10), day(12), day(20))
    got = pairs(spark, [name(n) for n in (9, 10, 11, 12, 19, 20)], [dep])
    assert got == [(1, 1), (1, 2), (1, 3), (1, 4)]


def test_activation_and_deployment_on_the_file_day(spark):
    dep = ("C-POD-912", "S", day(10), day(10), day(20))
    names = [name(10), name(11)]
    assert pairs(spark, names, [dep]) == [(1, 1)]
    assert pairs(spark, names, [dep], inclusive=True) == [(1, 0), (1, 1)]


def test_serials_match_whole_or_by_start(spark):
    names = [name(5), name(5, "POD91"), name(5, "FPOD_912"), name(5, "CPOD_912"), name(5, "POD 912")]
    deps = [("C-POD-91", "S", day(1), day(2), day(9)), ("912", "S", day(1), day(2), day(9))]
    assert pairs(spark, names, deps) == [(1, 1), (2, 0), (2, 2), (2, 3), (2, 4)]
    assert pairs(spark, names, deps, mode="contains") == [(1, 0), (1, 1), (1, 2), (2, 0), (2, 2)]


def test_missing_dates_serials_and_raw_files_never_match(spark):
    names = [name(5), name(5, ext="CP1"), "S 2022-01-06 POD912 file01.CP3", "x.CP3"]
    deps = [("C-POD", "S", day(1), day(2), day(9)), ("912", "S", None, day(2), day(9)), ("912", "S", day(1), None, day(9)),
            ("912", "S", day(9), day(8), day(3)), ("912", "S", day(1), day(2), day(9))]
    assert pairs(spark, names, deps) == [(5, 0)]


@pytest.mark.parametrize("inclusive", [False, True])
def test_covered_days_are_those_in_range(spark, inclusive):
    days = [(a, d, e, x) for a in range(5) for d in range(5) for e in range(7) for x in range(8)]
    df = spark.createDataFrame(days, "a int, d int, e int, x int").select(*(F.date_from_unix_date(c).alias(c) for c in "adex"))
    first, until = M.covered_days(F.col("a"), F.col("d"), F.col("e"), inclusive)
    within = (F.unix_date("x") >= first) & (F.unix_date("x") < until)
    wrong = df.filter(within != M.in_range(F.col("x"), F.col("a"), F.col("d"), F.col("e"), inclusive))
    assert wrong.count() == 0


def test_blocks_hold_each_day_of_an_interval_once(spark, monkeypatch):
    monkeypatch.setattr(M, "TOP_LEVEL", 4)
    spans = [(a, b) for a in range(-40, 41, 3) for b in range(a, a + 75, 2)]
    df = spark.createDataFrame(spans, "first int, until int")
    for r in df.withColumn("blocks", M.day_blocks(F.col("first"), F.col("until"))).collect():
        held = [d for level, block in r.blocks for d in range(block << level, (block + 1) << level)]
        assert sorted(held) == list(range(r.first, r.until))
        assert len([1 for level, _ in r.blocks if level < 4]) <= 2 * 4
    own = spark.createDataFrame([(n,) for n in (-17, 0, 5)], "n int").select("n", M.blocks_of_day(F.date_from_unix_date("n")).alias("at"))
    for r in own.collect():
        assert [tuple(b) for b in r["at"]] == [(k, r.n >> k) for k in range(5)]


def test_long_deployments_are_few_rows(spark):
    """No row a day: 30 years are fewer than 2 x 14 blocks, and an end date far off adds blocks of 45 years."""
    deps = [("912", "S", day(1), day(2), day(30 * 365)), ("912", "S", day(1), day(2), dt.datetime(9999, 1, 1))]
    index = M.match_index(files(spark, name(5), name(7)), deployments(spark, *deps))
    sizes = dict(rows(index.covered.groupBy("row_no").count()))
    assert sizes[1] <= 2 * M.TOP_LEVEL and sizes[2] <= 2 * M.TOP_LEVEL + 3_000_000 // 2**M.TOP_LEVEL
    assert rows(M.match_pairs(index), "row_no", "sel_no") == [(1, 0), (1, 1), (2, 0), (2, 1)]


@pytest.mark.parametrize("mode", ["serial", "contains"])
def test_index_results_equal_the_pair_list(spark, mode):
    random.seed(8)
    names = [name(random.randrange(30), f"POD{random.choice([9, 91, 912])}", random.choice(["CP3", "FP3"]), f"S{i}") for i in range(80)]
    deps = [(f"C-POD-{random.choice([9, 91, 912])}", "S", day(a), day(a + random.randrange(4)), day(a + random.randrange(12)))
            for a in (random.randrange(28) for _ in range(25))]
    index = M.match_index(files(spark, *names), deployments(spark, *deps), mode)
    found = M.match_pairs(index).collect()
    want = {}
    for r in found:
        want.setdefault(r.row_no, []).append((r.sel_no, r.name_ext))
    got = {r.row_no: (r.MatchCount, r.PodType) for r in M.annotate(deployments(spark, *deps), index).collect()}
    for i in range(1, len(deps) + 1):
        own = sorted(want.get(i, []))
        kind = {"CP3": "C-POD", "FP3": "F-POD"}[own[-1][1][-3:]] if own else ""
        assert got[i] == (len(own), kind)
    first = {}
    for r in found:
        first[r.name_ext.lower()] = min(first.get(r.name_ext.lower(), 99), r.row_no)
    assert dict(rows(M.first_deployment(index), "lower_name", "row_no")) == first
    lone = {r.FileName.lower() for r in M.file_only_rows(files(spark, *names), index).collect()}
    assert lone == {n.lower() for n in names} - set(first)
    lists = {}
    for r in M.file_lists(M.match_pairs(index), per_row=3).collect():
        assert len(r.MatchingFiles) <= 3
        lists.setdefault(r.row_no, []).append((r.list_no, r.MatchingFiles))
    assert {k: sum((m for _, m in sorted(v)), []) for k, v in lists.items()} == {k: [n for _, n in sorted(v)] for k, v in want.items()}


def test_deployment_rows_and_receivers(spark):
    deps = deployments(spark, ("C-POD-912", "KF2", day(1), day(2), day(9)), ("F-POD 912", "KF3", day(20), day(21), day(29)),
                       ("C-POD-5", "KF4", day(1), day(2), day(9)), ("none", "KF5", day(1), day(2), day(9)))
    index = M.match_index(files(spark, name(5), name(25, "FPOD_912", "FP3"), name(15)), deps)
    got = M.match_deployments(files(spark, name(5), name(25, "FPOD_912", "FP3"), name(15)), deps, index)
    listed = {(r.row_no, r.RowType, r.RECEIVER, r.MatchCount, r.PodType, r.DeploymentID, r.FileName) for r in got.collect()}
    assert listed == {
        (1, "metadata", "912", 1, "C-POD", "KF2 2022 01 03 POD912", None),
        (2, "metadata", "912", 1, "F-POD", "KF3 2022 01 22 POD912", None),
        (3, "metadata", "C-POD-5", 0, "", "KF4 2022 01 03 POD5", None),
        (4, "metadata", "none", 0, "", None, None),
        (None, "file-only", None, 0, "C-POD", None, name(15)),
    }
    one = M.receivers(got.filter("RowType = 'metadata'"))
    assert rows(one) == [("CHELONIA", "912", "C-POD", "Active")]


def test_process_list_takes_first_deployment_and_ignores_case(spark):
    deps = deployments(spark, ("912", "A", day(1), day(2), day(9)), ("912", "B", day(1), day(2), day(9)))
    listed = files(spark, name(5), name(6), name(19))
    index = M.match_index(listed, deps)
    chosen = listed.withColumn("name_ext", F.upper("name_ext"))
    got = M.process_list(chosen, listed, index, M.annotate(deps, index)).orderBy("sel_no")
    assert [(r.sel_no, r.row_no, r.deployment_id, r.path) for r in got.collect()] == [
        (0, 1, "A 2022 01 03 POD912", f"/d/{name(5)}"), (1, 1, "A 2022 01 03 POD912", f"/d/{name(6)}")]


def test_overview(spark):
    deps = deployments(spark, ("912", "A", day(1), day(2), day(9)))
    listed = files(spark, name(5), name(19))
    index = M.match_index(listed, deps)
    detections = spark.createDataFrame(
        [(name(5)[:-4], day(5)), (name(5)[:-4], day(6) + dt.timedelta(minutes=5))], "PODfile string, DETECTION_DATE_TIME timestamp_ntz"
    )
    status = spark.createDataFrame([(name(5)[:-4], "OK")], "pod_file string, status string")
    got = M.file_overview(listed, index, M.annotate(deps, index), M.detection_spans(detections), status)
    assert [tuple(r)[1:] for r in got.orderBy("sel_no").collect()] == [
        (name(5)[:-4], "Yes", "7 days, 0 hours, 0 minutes", "1 days, 0 hours, 5 minutes", "OK"),
        (name(19)[:-4], "No", "N/A", "N/A", "NOT ATTEMPTED"),
    ]


def test_exact_name_flags(spark):
    meta = spark.createDataFrame([("a.CP3", 1), ("b.CP3", 2)], "POD_FILE string, n int")
    got = M.exact_name_flags(meta, files(spark, "a.CP3", "c.CP3"))
    assert rows(got, "POD_FILE", "n", "MATCH") == [("a.CP3", 1, "Y"), ("b.CP3", 2, "N"), ("c.CP3", None, "N")]


def test_contains_drops_starts_of_serials_before_the_shuffle(spark):
    files = spark.createDataFrame([(1, "X 2022 05 01 POD10234 file01.CP3"), (2, "X 2022 05 01 POD999 file01.CP3")], "sel_no long, name_ext string")
    days = ["ACTIVATION_DATE_TIME", "DEPLOY_DATE_TIME", "VALID_DATA_UNTIL_DATE_TIME"]
    sheet = spark.createDataFrame([(1, "C-POD-102")], "row_no long, RECEIVER string")
    for c, day in zip(days, ("2022-04-01", "2022-04-02", "2022-06-01"), strict=True):
        sheet = sheet.withColumn(c, F.lit(day).cast("timestamp_ntz"))
    index = M.match_index(files, sheet, mode="contains")
    assert rows(M.match_pairs(index), "row_no", "sel_no") == [(1, 1)]
    plan = index.files._jdf.queryExecution().executedPlan().toString()
    # Reading from the top: the semi-join comes before any exchange of the exploded starts.
    assert "LeftSemi" in plan and "Exchange hashpartitioning" not in plan[: plan.index("LeftSemi")]


@pytest.mark.parametrize("find", [M.match_pairs, M.first_deployment, lambda index: M.file_lists(M.match_pairs(index))])
def test_blocks_and_names_are_never_broadcast(spark, find):
    """They are made by expressions, so their estimated size is that of the tables below."""
    names = [name(n, f"POD{900 + n % 3}") for n in range(40)]
    deps = [(f"C-POD-{900 + k}", "S", day(0), day(2), day(30)) for k in range(3)]
    found = find(M.match_index(files(spark, *names), deployments(spark, *deps)))
    assert found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    joined = [line for line in plan.splitlines() if "HashJoin" in line and ("serial" in line or "block" in line)]
    assert "SortMergeJoin" in plan and not joined

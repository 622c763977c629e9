from __future__ import annotations

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from clickloom import spec as S
from clickloom.functions import text as T
from clickloom.operators import deployments as P
from clickloom.sources import files as I

PARTS = {
    "RCV_PROJECT": "p1", "RECEIVER": "C-POD-912", "STATION_NAME": "KF2", "DEPLOY_LAT": "55.68079", "DEPLOY_LONG": "10.98065",
    "ACTIVATION_YEAR": "2022", "ACTIVATION_MONTH": "4", "ACTIVATION_DAY": "29", "ACTIVATION_TIME": "8:43",
    "DEPLOY_YEAR": "2022", "DEPLOY_MONTH": "5", "DEPLOY_DAY": "6", "DEPLOY_TIME": "10:48:00",
    "VALID_DATA_UNTIL_YEAR": "2022", "VALID_DATA_UNTIL_MONTH": "10", "VALID_DATA_UNTIL_DAY": "12", "VALID_DATA_UNTIL_TIME": "9:05:00",
    "BATTERY_END_YEAR": "2022", "BATTERY_END_MONTH": "9", "BATTERY_END_DAY": "23", "COMMENTS": "",
}


def sheet(spark, *changes):
    data = [(i, *{**PARTS, **c}.values()) for i, c in enumerate(changes or [{}], 1)]
    return spark.createDataFrame(data, "row_no long, " + ", ".join(f"{k} string" for k in PARTS))


def test_prepare_gives_the_declared_columns(spark):
    got = P.prepare_deployments(sheet(spark))
    assert tuple(got.columns) == ("row_no", *S.OUTPUT_ORDER)
    r = got.collect()[0]
    assert r.ACTIVATION_DATE_TIME == dt.datetime(2022, 4, 29, 8, 43)
    assert r.BATTERY_END_DATE == dt.datetime(2022, 9, 23)
    assert (r.DEPLOY_LAT, r.DEPLOY_LONG) == (55.68079, 10.98065)
    assert (r.COMMENTS, r.MOORING_TYPE, r.RECOVER_DATE_TIME) == ("Na", "Na", None)


@pytest.mark.parametrize(
    "change,message",
    [
        ({"STATION_NAME": " nan "}, "Mandatory columns contain empty values: STATION_NAME"),
        ({"DEPLOY_MONTH": "13"}, "Mandatory columns contain empty values: DEPLOY_DATE_TIME"),
        ({"DEPLOY_YEAR": "1985", "ACTIVATION_YEAR": "1991"}, "Row 1: DEPLOY_DATE_TIME is earlier than minDate."),
        ({"DEPLOY_YEAR": "2023"}, "Deployment date must be before valid until date."),
        ({"DEPLOY_LAT": "x", "DEPLOY_LONG": "181"}, "Row 1: - Invalid latitude and longitude."),
        ({"DEPLOY_LAT": "-91"}, "Row 1: - Invalid latitude."),
        ({"DEPLOY_LONG": ""}, "Mandatory columns contain empty values: DEPLOY_LONG"),
        ({"RCV_PROJECT": "NaN"}, "Mandatory columns contain empty values: RCV_PROJECT"),
    ],
)
def test_strict_checks_raise(spark, change, message):
    with pytest.raises(P.MetadataError) as error:
        P.prepare_deployments(sheet(spark, change))
    assert message in str(error.value).split("\n")


def test_missing_columns_are_named(spark):
    with pytest.raises(P.MetadataError, match="Missing mandatory columns: RECEIVER"):
        P.prepare_deployments(sheet(spark).drop("RECEIVER"))
    assert rows(P.missing_column_rows(P.upper_names(sheet(spark).drop("RECEIVER")), ("RECEIVER", "STATION_NAME"))) == [("RECEIVER", 1)]


def test_project_choice(spark):
    two = sheet(spark, {}, {"RCV_PROJECT": " p2 "}, {"RCV_PROJECT": "p2"})
    with pytest.raises(P.MetadataError, match="Several projects"):
        P.prepare_deployments(two)
    assert rows(P.prepare_deployments(two, "p2"), "row_no") == [(2,), (3,)]
    with pytest.raises(P.MetadataError, match="0 rows"):
        P.prepare_deployments(two, "p3")
    assert rows(P.projects(two), "label") == [("p1 (n=1)",), ("p2 (n=2)",)]


def test_violations_come_as_rows(spark):
    bad = P.conform(P.assemble_dates(sheet(spark, {"DEPLOY_YEAR": "2023", "DEPLOY_LAT": "x"}, {})))
    assert rows(P.violations(bad), "check_id", "row_no", "column_name") == [("V4", 1, "DEPLOY_DATE_TIME"), ("V5", 1, "DEPLOY_LAT")]


def test_options_are_opt_in(spark):
    odd = P.conform(P.assemble_dates(sheet(spark)).withColumn("MOORING_TYPE", F.lit("tree")))
    assert rows(P.violations(odd)) == []
    assert rows(P.violations(odd, with_options=True), "check_id", "column_name") == [("V10", "MOORING_TYPE")]


def test_optional_blank_dates_become_null_and_nan_text_stays(spark):
    df = P.assemble_dates(sheet(spark)).withColumns({"DOWNLOAD_DATE_TIME": F.lit(" NaN "), "COMMENTS": F.lit("nan")})
    r = P.conform(df).collect()[0]
    assert (r.DOWNLOAD_DATE_TIME, r.COMMENTS) == (None, "nan")
    wide = P.conform(df.withColumn("RCV_PROJECT", F.lit("")), marker=S.EXPORT_MARKER, all_columns=True).collect()[0]
    assert (wide.RCV_PROJECT, wide.MOORING_TYPE) == ("NaN", "NaN")


def test_sheet_reader_takes_text_in_file_order(spark, tmp_path):
    names = list(PARTS) + [f"H{i}" for i in range(30)]
    lines = [",".join(names)]
    for i in range(20):
        lines.append(",".join([*{**PARTS, "STATION_NAME": f"S{i}"}.values(), *["1"] * 30]))
    (tmp_path / "sheet.csv").write_text("\n".join(lines) + "\n")
    got = I.read_sheet(spark, str(tmp_path / "sheet.csv"))
    assert got.columns[:-1] == names[: S.SHEET_COLUMNS] and {t for c, t in got.dtypes if c != "row_no"} == {"string"}
    assert rows(got, "row_no", "STATION_NAME") == [(i + 1, f"S{i}") for i in range(20)]


@pytest.mark.parametrize(
    "text,want",
    [
        ("2022-04-29T08:43:00Z", dt.datetime(2022, 4, 29, 8, 43)),
        ("4/29/2022 8:43", dt.datetime(2022, 4, 29, 8, 43)),
        ("29/4/2022", dt.datetime(2022, 4, 29)),
        ("5/6/2022 10:48:01", dt.datetime(2022, 5, 6, 10, 48, 1)),
        ("44680.5", dt.datetime(2022, 4, 29, 12)),
        ("0022-04-29 08:43:00", None),
        ("soon", None),
        ("  ", None),
        ("31/31/2022", None),
    ],
)
def test_mixed_dates(spark, text, want):
    got = spark.createDataFrame([(text,)], "c string").select(T.parse_any_timestamp(F.col("c")).alias("t")).collect()[0].t
    assert got == want


def test_day_first_is_a_choice(spark):
    df = spark.createDataFrame([("5/6/2022",)], "c string")
    got = df.select(T.parse_any_timestamp(F.col("c"), month_first=False).alias("t")).collect()[0].t
    assert got == dt.datetime(2022, 6, 5)


@pytest.mark.parametrize("seconds,want", [(0, "0 days, 0 hours, 0 minutes"), (90061, "1 days, 1 hours, 1 minutes"), (None, "NaN")])
def test_durations(spark, seconds, want):
    df = spark.createDataFrame([(seconds,)], "s long")
    assert df.select(T.format_duration(F.col("s")).alias("t")).collect()[0].t == want


@pytest.mark.parametrize("text,want,ok", [("5.1234", "05.12340", True), ("55.68079", "55.68079", True), ("5.12", "05.12", False), ("x", "x", False), ("", "", True)])
def test_coordinates(spark, text, want, ok):
    df = spark.createDataFrame([(text,)], "c string")
    r = df.select(T.normalise_coordinate(F.col("c")).alias("n"), T.coordinate_ok(F.col("c")).alias("ok")).collect()[0]
    assert (r.n, r.ok) == (want, ok)


def test_every_violation_is_found(spark):
    """1,200 rows with a wrong order and one bad coordinate: the report names both, the table has every row."""
    early, late = dt.datetime(2022, 1, 1), dt.datetime(2022, 6, 1)
    columns = [S.ROLES[k] for k in ("ActivationDate", "DeployDate", "RecoverDate", "ValidUntilDate")]
    data = [(i, early, late, early, dt.datetime(2022, 12, 1), "55.68079", "10.98065") for i in range(1, 1201)]
    data.append((1201, early, early, late, late, "999", "10.98065"))
    schema = ", ".join(["row_no long", *[f"{c} timestamp_ntz" for c in columns], f"{S.ROLES['Latitude']} string", f"{S.ROLES['Longitude']} string"])
    df = spark.createDataFrame(data, schema)
    missing = [c for c in S.DATETIMES if c not in df.columns]
    found = P.violations(df.withColumns({c: F.lit(None).cast("timestamp_ntz") for c in missing}))
    with pytest.raises(P.MetadataError) as error:
        P.raise_on(found)
    lines = str(error.value).split("\n")
    assert lines.count("Deployment date must be before recovery date.") == 1
    assert any(line.startswith("Row 1201: ") for line in lines)
    table = spark.read.parquet(error.value.path)
    assert table.count() == found.count() >= 1201


def test_more_messages_than_are_shown(spark, monkeypatch):
    monkeypatch.setattr(P, "SHOWN", 3)
    rows_ = [("V3", i, "A", f"Row {i}: A") for i in range(1, 11)] + [("V5", 99, "B", "Row 99: B")]
    with pytest.raises(P.MetadataError, match="7 more of V3 A") as error:
        P.raise_on(spark.createDataFrame(rows_, "check_id string, row_no long, column_name string, message string"))
    assert "Row 99: B" in str(error.value) and error.value.path in str(error.value)
    P.raise_on(spark.createDataFrame([], "check_id string, row_no long, column_name string, message string"))


def test_sheet_cells_may_hold_line_breaks_and_quotes(spark, tmp_path):
    (tmp_path / "sheet.csv").write_text('A,COMMENTS\n1,"two\nlines"\n2,"a ""quoted"" word"\n3,plain\n')
    got = I.read_sheet(spark, str(tmp_path / "sheet.csv"))
    assert rows(got, "row_no", "A", "COMMENTS") == [(1, "1", "two\nlines"), (2, "2", 'a "quoted" word'), (3, "3", "plain")]

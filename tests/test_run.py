"""The whole run on a small folder of files and a sheet."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import rows
from test_detector_files import CP1_CLICK, CP1_MINUTE, START, cp_click, cp_minute, record, timed, walk_cpod, walk_fpod, write

from clickloom.operators import deployments as P
from clickloom.plans import harmonise as H

COLUMNS = [
    "RCV_PROJECT", "RECEIVER", "STATION_NAME", "DEPLOY_LAT", "DEPLOY_LONG",
    *[f"{p}_{x}" for p in ("ACTIVATION", "DEPLOY", "VALID_DATA_UNTIL") for x in ("YEAR", "MONTH", "DAY", "TIME")],
    "MOORING_TYPE",
]
LINES = [
    "p1,C-POD-912,KF2,55.68,10.98,2024,4,30,8:43,2024,5,1,10:01,2024,5,1,10:03:00,bottom-mooring",
    "p1,F-POD-6601,KF3,55.68,10.98,2024,4,30,8:43,2024,5,1,9:00,2024,5,3,9:00:00,balloon",
    "p1,C-POD-77,KF4,55.68,10.98,2024,4,30,8:43,2024,5,1,9:00,2024,5,3,9:00:00,",
    "p2,C-POD-5,KF5,55.68,10.98,2024,4,30,8:43,2024,5,1,9:00,2024,5,3,9:00:00,raft",
]
CP = "KF2O 2024 04 30 POD912 file01"
FP = "KF3O 2024 05 01 FPOD_6601 file0"
LATE = "KF2O 2024 06 01 POD912 file01"


@pytest.fixture()
def folder(tmp_path):
    root = tmp_path / "files"
    (root / "sub").mkdir(parents=True)
    three = []
    for k in range(6):
        three += [cp_minute(60 + k, 20, 0), cp_click(100, 1, 3), cp_click(5000, 1, 3)]
    three.append(cp_minute())
    one = [CP1_MINUTE, CP1_CLICK, CP1_CLICK] * 7
    write(root, f"{CP}.CP3", 760, three)
    write(root, f"{CP}.CP1", 360, one)
    # A copy elsewhere, a cropped variant, a lone file and one that no deployment wants.
    write(root / "sub", f"{CP}.CP3", 760, three)
    write(root, f"{CP} PART 1.CP3", 760, three * 2)
    write(root, f"{CP} PART 1.CP1", 360, one * 2)
    write(root, "lone 2024 05 01 POD3 file01.CP3", 760, three)
    write(root, f"{LATE}.CP3", 760, three)
    write(root, f"{LATE}.CP1", 360, one)
    fpod = [record(16, b1=254, b4=20, b8=9, b10=7), record(16, b1=249, b15=64 + 2, b16=1), timed(16, 300), record(16, b1=254, b4=20)]
    write(root / "sub", f"{FP}.FP3", 1024, fpod)
    write(root / "sub", f"{FP}.FP1", 1024, fpod)
    (tmp_path / "sheet.csv").write_text("\n".join([",".join(COLUMNS), *LINES]) + "\n")
    return tmp_path, three, one, fpod


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_run_writes_all_tables(spark, folder, fmt):
    base, three, one, fpod = folder
    got = H.run(spark, str(base / "files"), str(base / "sheet.csv"), str(base / "out"), project="p1", fmt=fmt)
    low, high = dt.datetime(2024, 5, 1, 10, 1), dt.datetime(2024, 5, 1, 10, 3)
    want = [(*r[:4], "KF2 2024 05 01 POD912", *r[5:], CP) for r in walk_cpod(CP, three, one) if low <= r[0] <= high]
    want += [(*r[:4], "KF3 2024 05 01 POD6601", *r[5:], FP) for r in walk_fpod(FP, fpod)]
    columns = list(H.D.OUTPUT_COLUMNS) + ["PODfile"]
    assert rows(got["detections"], *columns) == sorted(want)
    assert len(want) == 9 + 6 and START < low
    assert rows(got["deployments"], "RECEIVER", "STATION_NAME", "COMMENTS") == [("6601", "KF3", "Na"), ("912", "KF2", "Na")]
    assert rows(got["receivers"], "RECEIVER_ID_SERIAL_NUMBER", "RECEIVER_MODEL") == [("6601", "F-POD"), ("912", "C-POD")]
    assert rows(got["overview"], "Filename", "MetadataMatch", "MetadataDeployment", "DetectionSpan", "Status") == [
        (CP, "Yes", "0 days, 0 hours, 2 minutes", "0 days, 0 hours, 2 minutes", "OK"),
        (LATE, "No", "N/A", "N/A", "NOT ATTEMPTED"),
        (FP, "Yes", "2 days, 0 hours, 0 minutes", "0 days, 0 hours, 1 minutes", "OK"),
    ]
    assert got["bad_files"].count() == 0
    assert rows(got["violations"], "check_id", "row_no", "column_name") == [("V10", 2, "MOORING_TYPE")]
    assert {r.reason for r in got["rejected_files"].collect()} == {"WORSE_VARIANT"}
    assert [r.path.rsplit("/", 1)[1] for r in got["file_problems"].collect()] == ["lone 2024 05 01 POD3 file01.CP3"]


def test_run_needs_a_choice_of_project(spark, folder):
    base = folder[0]
    with pytest.raises(P.MetadataError, match="Several projects"):
        H.run(spark, str(base / "files"), str(base / "sheet.csv"), str(base / "out"))

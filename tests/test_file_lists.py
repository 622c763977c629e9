from __future__ import annotations

import pytest
from conftest import rows

from clickloom.operators import files as P

SCHEMA = "sel_no long, path string, name_ext string, bytes long"


def listed(spark, *names, size=100):
    data = []
    for i, n in enumerate(names):
        name, bytes_ = n if isinstance(n, tuple) else (n, size)
        folder, _, base = name.rpartition("/")
        data.append((i, f"{folder}/{base}" if folder else f"/d/{base}", base, bytes_))
    return spark.createDataFrame(data, SCHEMA)


@pytest.mark.parametrize(
    "name,base_key,family,kind,score",
    [
        ("KF2O 2022 04 29 POD912 file01.CP1", "20220429_912_01", "CP", "1", 0),
        ("TR 2022 12 02 FPOD_6601 file0.FP3", "20221202_6601_00", "FP", "3", 0),
        ("CPOD1686 2011 11 09 POD1686 file01.CP3", "20111109_1686_01", "CP", "3", 3),
        ("x 2023-1-9 POD 1593 file 1.cp3", "20230109_1593_01", "CP", "3", 0),
        ("x 2022 04 29 POD912 file01 PART 2.CP3", "20220429_912_01", "CP", "3", 2),
        ("x 2022 04 29 POD912 North file01.CP3", "20220429_912_01", "CP", "3", 3),
        ("x 2022 04 29 POD912 file01_FPODsoftware.FP1", "20220429_912_01", "FP", "1", 2),
        ("plain.CP3", "UNKNOWNDATE_UNKNOWN_NA", "CP", "3", 5),
        ("x 2022 13 45 POD7.CP3", "UNKNOWNDATE_7_NA", "CP", "3", 5),
        ("x 2022 04 29 POD912 file007.CP1.CP3", "20220429_912_07", "CP", "3", 0),
        ("x 2022 04 29 POD912 file123.CP3", "20220429_912_123", "CP", "3", 0),
    ],
)
def test_names(spark, name, base_key, family, kind, score):
    got = P.with_name_fields(listed(spark, name)).collect()[0]
    assert (got.base_key, got.family, got.kind, got.name_score) == (base_key, family, kind, score)


def test_copies_need_same_name_and_size(spark):
    got = P.drop_copies(listed(spark, ("a/x.CP3", 5), ("b/X.cp3", 5), ("c/x.CP3", 6)))
    assert rows(got, "sel_no") == [(0,), (2,)]


def test_pair_check(spark):
    files = listed(spark, "a.CP1", "a.cp3", "b.CP1", "c.CP3", "d.FP1", "e.CP1.CP3", "f.FP3", "a.FP1")
    assert rows(P.paired(files), "name_ext") == [("a.CP1",), ("a.cp3",)]
    both = rows(P.pair_problems(files), "place", "path")
    assert both == [(0, "/d/e.CP1.CP3"), (1, "/d/b.CP1"), (2, "/d/a.FP1"), (2, "/d/d.FP1"), (3, "/d/c.CP3"), (4, "/d/f.FP3")]
    one_way = rows(P.pair_problems(files, both_ways=False), "path")
    assert one_way == [("/d/a.FP1",), ("/d/b.CP1",), ("/d/d.FP1",), ("/d/e.CP1.CP3",)]
    text = P.pair_message(P.pair_problems(files)).collect()[0]
    assert not text.is_valid and text.message.startswith("Found 6 problematic file(s): 1 with multiple")
    good = P.pair_message(P.pair_problems(listed(spark, "a.CP1", "a.CP3"))).collect()[0]
    assert (good.is_valid, good.message) == (True, "")


def test_unsupported_extension(spark):
    got = P.unsupported(listed(spark, "a.CP1", "b.wav", "c")).collect()
    assert [r.name_ext for r in got] == ["b.wav", "c"]
    assert got[0].message == "Unsupported file type: .WAV. Supported types: .CP1, .CP3, .FP1, .FP3."


BASE = "S 2022 04 29 POD912 file01"


def test_clean_name_beats_larger_cropped_copy(spark):
    files = listed(spark, (f"{BASE}.CP1", 10), (f"{BASE}.CP3", 10), (f"{BASE} PART 1.CP1", 9_000_000), (f"{BASE} PART 1.CP3", 9_000_000))
    kept, rejected = P.dedup_files(files)
    assert rows(kept, "name_ext") == [(f"{BASE}.CP1",), (f"{BASE}.CP3",)]
    got = rejected.collect()
    assert {r.reason for r in got} == {"WORSE_VARIANT"} and len(got) == 2
    assert got[0].reason_detail == (
        f'Dedup by pair: this variant SumScore=4, SumBytes=1.8e+07, MinScore=2; best variant "{BASE}" SumScore=0, SumBytes=20, MinScore=0.'
    )


def test_same_score_takes_the_larger_then_the_first_name(spark):
    other = "T 2022 04 29 POD912 file01"
    files = listed(spark, (f"{other}.CP1", 10), (f"{other}.CP3", 11), (f"{BASE}.CP1", 10), (f"{BASE}.CP3", 10))
    assert rows(P.dedup_files(files)[0], "name_ext") == [(f"{other}.CP1",), (f"{other}.CP3",)]
    files = listed(spark, f"{other}.CP1", f"{other}.CP3", f"{BASE}.CP1", f"{BASE}.CP3")
    assert rows(P.dedup_files(files)[0], "name_ext") == [(f"{BASE}.CP1",), (f"{BASE}.CP3",)]


def test_kept_and_rejected_cover_the_input(spark):
    names = [f"{s} 2022 04 29 POD{i % 3} file01{x}.CP{k}" for s in "AB" for i in range(6) for x in ("", " PART") for k in (1, 3)]
    names += ["nothing.CP1", "nothing.CP3", "never.CP1", "never.CP3"]
    files = listed(spark, *names)
    kept, rejected = P.best_files(files)
    both = sorted([r.path for r in kept.collect()] + [r.path for r in rejected.collect()])
    assert both == sorted(r.path for r in files.collect())
    # Names without date and serial share one group, so one of them survives.
    assert [r.name_ext for r in kept.collect() if r.name_ext.startswith("n")] == ["never.CP1", "never.CP3"]


def test_input_order_does_not_matter(spark):
    names = [f"S 2022 04 29 POD{i % 5} file0{i % 2}{x}.CP{k}" for i in range(20) for x in ("", " PART") for k in (1, 3)]
    files = listed(spark, *dict.fromkeys(names))
    shuffled = files.repartition(7, "name_ext").orderBy("bytes", "name_ext")
    assert rows(P.dedup_files(files)[0], "path") == rows(P.dedup_files(shuffled)[0], "path")

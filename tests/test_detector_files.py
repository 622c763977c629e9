"""Detector files written byte by byte, read and harmonised, against a plain walk over the same records."""

from __future__ import annotations

import datetime as dt
import math
import random
from collections import defaultdict

import pytest
from conftest import rows

from clickloom.operators import detections as D
from clickloom.plans import harmonise as H
from clickloom.sources import files as I, records as Q, trains as J

START = dt.datetime(2024, 5, 1, 10, 0)
START_MINUTE = int((START - dt.datetime(1899, 12, 30)).total_seconds() // 60)


def header(size, version=900, tilt=(8, 100)):
    h = bytearray(size)
    h[256:260] = START_MINUTE.to_bytes(4, "big")
    h[64], h[65] = tilt
    h[39:41] = version.to_bytes(2, "big")
    return bytes(h)


def record(size, **at):
    r = bytearray(size)
    for k, v in at.items():
        r[int(k[1:]) - 1] = v
    return bytes(r)


def timed(size, ticks, **at):
    return record(size, b1=ticks >> 16, b2=(ticks >> 8) & 255, b3=ticks & 255, **at)


def cp_click(ticks, train, cls):
    return timed(40, ticks, b4=9, b8=77, b37=cls, b40=train)


def cp_minute(temp=60, tilt=20, raw=0):
    return record(40, b4=temp, b5=tilt, b9=raw, b40=254)


CP_EOF = record(40, b40=255)
CP1_CLICK, CP1_MINUTE, CP1_EOF = record(10, b10=3), record(10, b10=254), record(10, b10=255)


def write(folder, name, size, parts):
    (folder / name).write_bytes(header(size) + b"".join(parts))


def listing(spark, folder):
    files = I.list_pod_files(spark, str(folder))
    return files.withColumn("pod_file", H.N.stem(H.F.col("name_ext")))


def round_half_up(x):
    return float(math.floor(abs(x) + 0.5) * (1 if x >= 0 else -1))


def quality_rows(name, when, temp, angle, nall, trains, need_good, buzz=40_000):
    """Three output rows of one minute from trains: (quality, species, good, times)."""
    out = []
    for label, code in (("Hi", 3), ("Mod", 2), ("Lo", 1)):
        own = [t for t in trains if t[0] == code and t[1] == 0]
        n = sum(len(t[3]) for t in own if t[2] or not need_good)
        us = sum(t[3][-1] - t[3][0] for t in own)
        gaps = [b - a for t in own for a, b in zip(t[3], t[3][1:])]
        out.append((
            when, round_half_up(temp), round_half_up(angle), nall, name, label, n, int(n != 0), int(round_half_up(us * 0.001)),
            int(any(g < buzz for g in gaps)), int(nall is not None and nall > 4096), "NBHF",
            int(nall is not None and nall > 0 and round_half_up(angle) < 80),
        ))
    return out


def walk_cpod(name, three, one):
    """Detection rows of one C-POD file pair by a plain loop; ``one`` is None without a raw file."""
    ends = [i for i, r in enumerate(three) if r[39] == 255]
    three = three[: ends[0]] if ends else three
    marks = [i for i, r in enumerate(three) if r[39] == 254]
    raw = None
    if one is not None:
        kept = [r for r in one if r[9] != 255]
        at = [i for i, r in enumerate(kept) if r[9] == 254]
        raw = [b - a - 1 for a, b in zip(at, at[1:] + [len(kept)])]
        if len(marks) < len(at):
            marks = marks + [len(three) - 1]
    out = []
    for k, mark in enumerate(marks):
        before = three[marks[k - 1]] if k else None
        inside = three[marks[k - 1] + 1 : mark] if k else []
        groups = defaultdict(list)
        for r in inside:
            groups[r[39]].append(r)
        trains = [
            (g[0][36] & 3, g[0][36] >> 4, True, [5 * ((r[0] * 256 + r[1]) * 256 + r[2]) for r in g]) for g in groups.values()
        ]
        temp = before[3] / 5 if k else 0
        angle = math.degrees(math.acos(1 - before[4] / 128)) if k else 0
        nall = raw[k] if raw is not None and k < len(raw) else None
        out += quality_rows(name, START + dt.timedelta(minutes=k), temp, angle, nall, trains, False)
    return out


def walk_fpod(name, records):
    records = [r for r in records if r[0] not in (247, 248, 250, 252, 253, 255)]
    marks = [i for i, r in enumerate(records) if r[0] == 254]
    out = []
    for k, mark in enumerate(marks):
        inside = records[mark + 1 : marks[k + 1] if k + 1 < len(marks) else len(records)]
        details = [r for r in inside if r[0] == 249]
        clicks = [5 * ((r[0] * 256 + r[1]) * 256 + r[2]) for r in inside if r[0] <= 183]
        groups = defaultdict(list)
        for d, t in zip(details, clicks):
            groups[d[15]].append((d, t))
        trains = [(g[0][0][14] & 3, (g[0][0][14] & 12) >> 2, g[0][0][14] & 64 == 64, [t for _, t in g]) for g in groups.values()]
        m = records[mark]
        angle = round_half_up(math.degrees(math.acos(1 - m[3] / 128)))
        out += quality_rows(name, START + dt.timedelta(minutes=k), m[7], angle, m[8] * 256 + m[9], trains, True)
    return out


def random_cpod(seed):
    random.seed(seed)
    three, one = [], []
    for k in range(random.randrange(4, 9)):
        for _ in range(random.choice([0, 0, 3, 12])):
            cls = random.choice([0, 1, 2, 3, 0x13, 0x52])
            three.append(cp_click(random.randrange(12_000_000), random.choice([1, 2, 9]), cls))
        three.append(cp_minute(random.randrange(256), random.randrange(200), random.randrange(3)))
        one.append(CP1_MINUTE)
        one += [CP1_CLICK] * random.choice([0, 1, 5000 if k == 2 else 7])
        if random.random() < 0.4:
            one.append(CP1_EOF)
    return three, one


@pytest.mark.parametrize("split", [120, 1 << 20])
def test_cpod_files_match_a_plain_walk(spark, tmp_path, monkeypatch, split):
    monkeypatch.setattr(J, "SPLIT_BYTES", split)
    pairs = {}
    for seed in range(4):
        pairs[f"R{seed} 2024 05 01 POD{seed} file01"] = random_cpod(seed)
    # Ends at the first end mark; garbage behind it.
    three, one = random_cpod(11)
    pairs["E 2024 05 01 POD11 file01"] = (three + [CP_EOF, cp_minute(), cp_click(1, 1, 3)], one)
    # One marker short of the raw file: a tail minute closed by the last record.
    three, one = random_cpod(12)
    pairs["T 2024 05 01 POD12 file01"] = (three + [cp_click(10, 1, 3), cp_click(90, 1, 3), cp_click(95, 1, 3)], one + [CP1_MINUTE, CP1_CLICK])
    # No click anywhere; more markers than the raw file.
    pairs["N 2024 05 01 POD13 file01"] = ([cp_minute(), cp_minute(), cp_minute()], [CP1_MINUTE, CP1_CLICK])
    # No raw file.
    pairs["A 2024 05 01 POD14 file01"] = (random_cpod(14)[0], None)
    want = []
    for name, (three, one) in pairs.items():
        write(tmp_path, f"{name}.CP3", 760, three)
        if one is not None:
            write(tmp_path, f"{name}.CP1", 360, one)
        want += walk_cpod(name, three, one)
    done = H.harmonise_cpod(listing(spark, tmp_path))
    key = lambda r: (r[4], r[0], r[5])
    assert sorted((tuple(r) for r in done.detections.collect()), key=key) == sorted(want, key=key)
    assert done.detections.columns == list(D.OUTPUT_COLUMNS)
    status = {r.pod_file: r.status for r in done.status.collect()}
    assert status.pop("A 2024 05 01 POD14 file01") == "PARTIAL"
    assert set(status.values()) == {"OK"} and len(status) == len(pairs) - 1


@pytest.mark.parametrize("split", [48, 1 << 20])
def test_fpod_files_match_a_plain_walk(spark, tmp_path, monkeypatch, split):
    monkeypatch.setattr(J, "SPLIT_BYTES", split)
    want = []
    for seed in range(4):
        random.seed(seed)
        parts = [timed(16, 5)]  # a click before the first minute
        for _ in range(6):
            parts.append(record(16, b1=254, b4=random.randrange(200), b8=random.randrange(40), b9=random.randrange(20), b10=random.randrange(256)))
            for _ in range(random.choice([0, 2, 9])):
                # Noise between the two halves, as other record types.
                parts.append(record(16, b1=249, b15=random.randrange(256), b16=random.choice([1, 2])))
                parts.append(record(16, b1=random.choice([247, 248, 250, 252, 253, 255, 200])))
                parts.append(timed(16, random.randrange(12_000_000)))
        name = f"F{seed} 2024 05 01 FPOD_{seed} file0"
        write(tmp_path, f"{name}.FP3", 1024, parts)
        write(tmp_path, f"{name}.FP1", 1024, parts[:1])
        want += walk_fpod(name, parts)
    done = H.harmonise_fpod(listing(spark, tmp_path))
    key = lambda r: (r[4], r[0], r[5])
    assert sorted((tuple(r) for r in done.detections.collect()), key=key) == sorted(want, key=key)


def test_bad_files_do_not_stop_the_rest(spark, tmp_path):
    three, one = random_cpod(3)
    for name in ("good", "short"):
        write(tmp_path, f"{name} 2024 05 01 POD1 file01.CP3", 760, three)
        write(tmp_path, f"{name} 2024 05 01 POD1 file01.CP1", 360, one)
    (tmp_path / "short 2024 05 01 POD1 file01.CP3").write_bytes(b"x" * 100)
    done = H.harmonise_cpod(listing(spark, tmp_path))
    status = {r.pod_file[:5].strip(): (r.status, r.error) for r in done.status.collect()}
    assert status["good"] == ("OK", None)
    assert status["short"][0] == "FAILED" and "shorter than its header" in status["short"][1]
    assert {r.filename[:4] for r in done.detections.collect()} == {"good"}


def test_reader_filters_types_and_bytes(spark, tmp_path):
    write(tmp_path, "x.CP1", 360, [CP1_CLICK, CP1_MINUTE, CP1_EOF, CP1_CLICK])
    files = listing(spark, tmp_path)
    read = Q.read_records(files, "CP1", (10,), (254,))
    assert rows(read, "rec_no", "rec_type", "b10") == [(2, 254, 254)]
    assert rows(Q.read_records(files, "CP1"), "rec_no", "rec_type") == [(1, 3), (2, 254), (4, 3)]


def test_header_facts(spark, tmp_path):
    write(tmp_path, "x.FP3", 1024, [])
    got = Q.read_headers(listing(spark, tmp_path), "FP3").collect()[0]
    # The version is wide enough to pass 801.
    assert (got.start_time, got.tilt_min, got.tilt_max, got.version, got.has_extended_amps) == (START, 8, 100, 900, True)


@pytest.mark.parametrize(
    "path,inner",
    [("/a b/c#1 100%.CP3", "/a b/c#1 100%.CP3"), ("file:/a b/c#1.CP3", "/a b/c#1.CP3"), ("file:///a b/c?.CP3", "/a b/c?.CP3")],
)
def test_local_paths_keep_odd_characters(path, inner):
    assert Q.filesystem(path)[1] == inner


def test_odd_file_names_are_read(spark, tmp_path):
    odd = tmp_path / "a b#1"
    odd.mkdir()
    write(odd, "x 100% +1.CP1", 360, [CP1_MINUTE, CP1_CLICK])
    read = Q.read_records(listing(spark, tmp_path), "CP1")
    assert rows(read, "pod_file", "rec_type", "error") == [("x 100% +1", 3, None), ("x 100% +1", 254, None)]


def test_listing_finds_any_case_and_folder(spark, tmp_path):
    (tmp_path / "deep er").mkdir()
    for name in ("a.CP1", "deep er/b.cp3", "c.fP1", "d.FP3", "e.wav", "f.CP2"):
        (tmp_path / name).write_bytes(b"1234")
    got = I.list_pod_files(spark, str(tmp_path))
    assert rows(got, "name_ext", "bytes") == [("a.CP1", 4), ("b.cp3", 4), ("c.fP1", 4), ("d.FP3", 4)]
    assert rows(got, "sel_no") == [(1,), (2,), (3,), (4,)]


def test_trains_from_files(spark, tmp_path):
    clicks = [cp_click(100, 2, 3), cp_click(40, 2, 1), cp_click(7, 1, 2)]
    write(tmp_path, "x.CP3", 760, [cp_minute(), *clicks, cp_minute()])
    write(tmp_path, "x.CP1", 360, [CP1_MINUTE, CP1_MINUTE])
    got = H.cpod_trains(listing(spark, tmp_path)).rows
    assert rows(got, "train_id", "no_of_clicks", "quality", "time_us", "ici_us", "nix", "minute_start") == [
        (1, 1, "Medium", [35], [], [77], START + dt.timedelta(minutes=1)),
        (2, 2, "High", [500, 200], [-300], [77, 77], START + dt.timedelta(minutes=1)),
    ]


@pytest.mark.parametrize("split", [16, 48, 1 << 20])
def test_filtered_click_counts(spark, tmp_path, monkeypatch, split):
    monkeypatch.setattr(Q.read_records, "__defaults__", ((), None, split, (), False))

    def click(raw, ipi):
        return record(16, b1=1, b7=ipi - 1, b11=raw)

    minute = record(16, b1=254)
    # Real amplitudes with version 900: 5 -> 10 (too low), 6 -> 12; 4000/10 = 400 kHz and 4000/210 = 19 kHz are out.
    parts = [click(90, 40), minute, click(5, 40), click(6, 40), click(90, 10), click(90, 210), minute, minute, click(250, 100)]
    write(tmp_path, "x.FP1", 1024, parts)
    got = H.filtered_click_counts(listing(spark, tmp_path)).rows
    assert rows(got, "minute_no", "nall") == [(1, 1), (2, 0), (3, 1)]


def listed(spark, *rows):
    return spark.createDataFrame(rows, "pod_file string, path string, bytes long")


def test_a_file_that_cannot_be_opened_for_another_reason_stops_the_job(spark, tmp_path):
    """Only what stays so for ever is quarantined; the rest rises, so that Spark tries again."""
    (tmp_path / "x.CP3").mkdir()
    files = listed(spark, ("x", str(tmp_path / "x.CP3"), 800))
    for read in (J.read_trains(files, "CP3"), J.read_click_counts(files), Q.read_records(files, "CP3"), Q.read_headers(files, "CP3")):
        with pytest.raises(Exception, match="x.CP3"):
            read.collect()


def test_a_fault_on_the_first_try_is_gone_on_the_second(spark, tmp_path):
    """A reader that fails with a time-out raises; read again, the range gives all of its records."""
    from clickloom.layout import LAYOUTS

    write(tmp_path, "x.CP1", 360, [CP1_MINUTE, CP1_CLICK])
    opened, tries = Q._open, []

    def flaky(path):
        tries.append(path)
        if len(tries) == 1:
            raise TimeoutError("store did not answer")
        return opened(path)

    Q._open = flaky
    try:
        with pytest.raises(TimeoutError):
            list(Q.record_blocks(str(tmp_path / "x.CP1"), LAYOUTS["CP1"], 0, 2))
        assert [len(b) for _, b in Q.record_blocks(str(tmp_path / "x.CP1"), LAYOUTS["CP1"], 0, 2)] == [2]
    finally:
        Q._open = opened


@pytest.mark.parametrize("path", ["wasbs://box@account/x.CP3", "oss://bucket/x.CP3"])
def test_unknown_file_systems_stop_before_reading(spark, path):
    files = listed(spark, ("x", path, 800))
    for read in (lambda: J.read_trains(files, "CP3"), lambda: Q.read_records(files, "CP3"), lambda: Q.read_headers(files, "CP3")):
        with pytest.raises(ValueError, match="cannot be read"):
            read()


@pytest.mark.parametrize("split", [120, 400, 1 << 20])
def test_a_range_that_fails_takes_its_file_out_of_rows_and_status(spark, tmp_path, monkeypatch, split):
    monkeypatch.setattr(J, "SPLIT_BYTES", split)
    three, one = random_cpod(3)
    for name in ("good", "cut"):
        write(tmp_path, f"{name} 2024 05 01 POD1 file01.CP3", 760, three)
        write(tmp_path, f"{name} 2024 05 01 POD1 file01.CP1", 360, one)
    files = listing(spark, tmp_path)
    grown = H.F.when(H.F.col("path").rlike("cut.*CP3$"), H.F.col("bytes") + 4000).otherwise(H.F.col("bytes"))
    done = H.harmonise_cpod(files.withColumn("bytes", grown))
    assert {r.pod_file[:4].strip(): r.status for r in done.status.collect()} == {"good": "OK", "cut": "FAILED"}
    want = walk_cpod("good 2024 05 01 POD1 file01", three, one)
    key = lambda r: (r[4], r[0], r[5])
    assert sorted((tuple(r) for r in done.detections.collect()), key=key) == sorted(want, key=key)
    trains = H.cpod_trains(files.withColumn("bytes", grown))
    assert {r.pod_file[:4].strip(): r.status for r in trains.status.collect()} == {"good": "OK", "cut": "FAILED"}
    assert {r.pod_file[:4] for r in trains.rows.collect()} <= {"good"}


def test_a_bad_raw_file_leaves_the_train_file_in(spark, tmp_path):
    three, one = random_cpod(5)
    name = "R 2024 05 01 POD1 file01"
    write(tmp_path, f"{name}.CP3", 760, three)
    write(tmp_path, f"{name}.CP1", 360, one)
    grown = H.F.when(H.F.col("path").endswith("CP1"), H.F.col("bytes") + 50).otherwise(H.F.col("bytes"))
    done = H.harmonise_cpod(listing(spark, tmp_path).withColumn("bytes", grown))
    status = done.status.collect()[0]
    assert status.status == "PARTIAL" and "file ends inside" in status.error
    want = walk_cpod(name, three, None)
    key = lambda r: (r[4], r[0], r[5])
    assert sorted((tuple(r) for r in done.detections.collect()), key=key) == sorted(want, key=key)


@pytest.mark.parametrize("held", [1, 1 << 20])
def test_ranges_of_any_size_give_the_same_trains(spark, tmp_path, monkeypatch, held):
    """Arrays and facts of trains do not depend on where ranges and minutes are cut."""
    monkeypatch.setattr(J, "MAX_HELD", held)
    random.seed(21)
    parts = [timed(16, 5)]
    for _ in range(5):
        parts.append(record(16, b1=254, b4=50, b8=9, b9=1, b10=2))
        for _ in range(random.choice([1, 6, 30])):
            parts.append(record(16, b1=249, b15=random.randrange(256), b16=random.choice([1, 2])))
            if random.random() < 0.8:
                parts.append(timed(16, random.randrange(12_000_000)))
    write(tmp_path, "F 2024 05 01 FPOD_1 file0.FP3", 1024, parts)
    three, one = random_cpod(22)
    write(tmp_path, "C 2024 05 01 POD1 file01.CP3", 760, three)
    write(tmp_path, "C 2024 05 01 POD1 file01.CP1", 360, one)
    got = []
    for split in (48, 160, 1 << 20):
        monkeypatch.setattr(J, "SPLIT_BYTES", split)
        files = listing(spark, tmp_path)
        both = [H.cpod_trains(files).rows, H.fpod_trains(files).rows]
        got.append([sorted(map(str, (t.drop("minute_start").collect()))) for t in both])
    assert got[0] == got[1] == got[2] and all(got[0])


def test_fpod_plan_reads_once_and_shuffles_no_whole_minutes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(J, "SPLIT_BYTES", 16)
    write(tmp_path, "F 2024 05 01 FPOD_1 file0.FP3", 1024, [record(16, b1=254, b4=20), record(16, b1=249, b16=1), timed(16, 300)])
    plan = H.V.parts(J.read_trains(listing(spark, tmp_path), "FP3"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
    # The one shuffle after the read takes what a partial aggregate has left.
    after = plan[: plan.index("MapInArrow")]
    assert after.count("Exchange hashpartitioning") == 1 and "partial_count" in after

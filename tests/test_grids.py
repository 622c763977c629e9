from __future__ import annotations

import datetime as dt
import random
from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import functions as F

from clickloom.functions import amplitude as A
from clickloom.operators import reconcile as C, timegrid as G

T0 = dt.datetime(2024, 5, 1, 23, 59, 30, 500_000)
CLICKS = [(0, "NBHF", 3, 0.5), (0.2, "NBHF", 2, 0.25), (10, "NBHF", 1, 9.0), (40, "Sonar", 3, 1.0), (3700, "NBHF", 2, 2.0)]


def clicks(spark, data=CLICKS):
    made = [("a", T0 + dt.timedelta(seconds=s), sp, q, d) for s, sp, q, d in data]
    return spark.createDataFrame(made, "pod_file string, time timestamp_ntz, species string, quality int, duration double")


def spans(spark, end=4000):
    return spark.createDataFrame([("a", T0, T0 + dt.timedelta(seconds=end))], "pod_file string, start timestamp_ntz, end timestamp_ntz")


@pytest.mark.parametrize("unit,step", [("second", 1), ("minute", 60), ("hour", 3600)])
def test_grid_is_cut_to_the_unit_and_complete(spark, monkeypatch, unit, step):
    monkeypatch.setattr(G, "GRID_BLOCK", 7)
    start = {"second": T0.replace(microsecond=0), "minute": T0.replace(second=0, microsecond=0),
             "hour": T0.replace(minute=0, second=0, microsecond=0)}[unit]
    end = T0 + dt.timedelta(seconds=4000)
    want = [start + dt.timedelta(seconds=step * i) for i in range(int((end - start).total_seconds() // step) + 1)]
    assert [r[0] for r in rows(G.time_grid(spans(spark), unit), "time")] == want


def test_positive_seconds(spark):
    got = G.detection_positive(clicks(spark), spans(spark, 45), "second", ["pod_file"], only_nbhf=False)
    assert got.count() == 2 * 46 + 1  # the late click lies beyond the grid and stays
    hits = rows(got.filter("dps = 1"), "time", "species", "nclicks", "milliseconds", "quality")
    first = T0.replace(microsecond=0)
    assert hits == [
        (first, "NBHF", 2, 750.0, 3),
        (first + dt.timedelta(seconds=40), "Sonar", 1, 1000.0, 3),
        (first + dt.timedelta(seconds=3700), "NBHF", 1, 2000.0, 3),
    ]


def test_positive_hours_sum_positive_minutes(spark):
    got = G.detection_positive(clicks(spark), spans(spark), "hour", ["pod_file"])
    assert rows(got, "time", "milliseconds", "dpm", "dph") == [
        (dt.datetime(2024, 5, 1, 23), 750.0, 1, 1), (dt.datetime(2024, 5, 2, 0), 0.0, 0, 0), (dt.datetime(2024, 5, 2, 1), 2000.0, 1, 1)]


def test_click_counts_fill_zeros(spark):
    got = G.click_counts(clicks(spark), spans(spark), "hour", ["pod_file"])
    assert rows(got, "time", "nclicks") == [
        (dt.datetime(2024, 5, 1, 23), 3), (dt.datetime(2024, 5, 2, 0), 1), (dt.datetime(2024, 5, 2, 1), 1)]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_gaps_are_filled_without_a_join(spark):
    c = clicks(spark)
    shown = plan(G.click_counts(c, spans(spark), "second", ["pod_file"]))
    assert "Join" not in shown and "Window" in shown
    shown = plan(G.detection_positive(c, spans(spark), "second", ["pod_file"]))
    assert "FullOuter" not in shown


@pytest.mark.parametrize("run_bins", [3, 50, 32_768])
@pytest.mark.parametrize("unit", ["second", "minute", "hour"])
def test_gaps_equal_the_grid_joined(spark, monkeypatch, run_bins, unit):
    monkeypatch.setattr(G, "RUN_BINS", run_bins)
    rng = random.Random(run_bins)
    before = dt.datetime(1969, 12, 31, 23, 58, 20, 700_000)
    data, ranges = [], []
    for name, start in (("a", T0), ("b", before), ("none", T0), ("no clicks", T0)):
        length = rng.randrange(100, 400)
        if name != "none":  # its clicks have no span
            ranges.append((name, start, start + dt.timedelta(seconds=length)))
        if name != "no clicks":
            data += [(name, start + dt.timedelta(seconds=rng.uniform(-60, length + 60)), rng.choice(["NBHF", "Sonar"]), 3, 1.5) for _ in range(25)]
    data.append(("a", None, "NBHF", 3, 2.0))
    ranges.append(("turned", T0, T0 - dt.timedelta(seconds=1)))
    c = spark.createDataFrame(data, "pod_file string, time timestamp_ntz, species string, quality int, duration double")
    s = spark.createDataFrame(ranges, "pod_file string, start timestamp_ntz, end timestamp_ntz")
    keys = ["pod_file", "species"]
    counts = G.clicks_per_species(c, unit, ["pod_file"])
    seen = G.species_spans(s, c, ["pod_file"])
    want = G.fill_gaps(G.time_grid(seen, unit), counts, [*keys, "time"], ["nclicks", "duration"])
    got = G.fill_between(seen, counts, unit, keys, ["nclicks", "duration"])
    columns = [*keys, "time", "nclicks", "duration"]
    assert rows(got, *columns) == rows(want, *columns)
    assert [f.dataType for f in got.select(*columns).schema] == [f.dataType for f in want.select(*columns).schema]


def test_strict_needs_two_clicks(spark):
    with pytest.raises(G.NoDetections):
        G.detection_positive(clicks(spark, CLICKS[:1]), spans(spark), "minute", ["pod_file"], strict=True)
    with pytest.raises(G.NoDetections):
        G.click_counts(clicks(spark, []), spans(spark), "minute", ["pod_file"], strict=True)


def test_noise_joins_on_time(spark):
    c = clicks(spark)
    keys = ["pod_file"]
    got = G.with_noise(G.detection_positive(c, spans(spark), "hour", keys), G.click_counts(c, spans(spark), "hour", keys), keys)
    assert rows(got, "dpm", "nall") == [(0, 1), (1, 1), (1, 3)]


def reconciled(spark):
    minutes = [dt.datetime(2024, 1, 1, 0, m) for m in range(20)]
    ours = [(t, 10 + i, q) for i, t in enumerate(minutes[1:]) for q in ("Hi", "Mod", "Lo")]
    vendor = [(t, None if i == 3 else 9 + i + (i % 2)) for i, t in enumerate(minutes[:18])]
    return (
        spark.createDataFrame(ours, "DETECTION_DATE_TIME timestamp_ntz, NUMBER_CLICKS_TOTAL long, QUALITY string"),
        spark.createDataFrame(vendor, "dt timestamp_ntz, nall_m long"),
        minutes,
    )


def test_reconcile_report(spark):
    ours, vendor, _ = reconciled(spark)
    r = C.reconcile(ours, vendor).collect()[0]
    # Odd minutes are one off, minute 3 is an empty vendor count and so 0.
    assert (r.row_difference, r.missing_in_ours, r.missing_in_vendor, r.n_mismatch, r.verdict) == (-1.0, 1, 2, 9, "FAIL")
    assert rows(C.missing_minutes(ours, vendor)) == [(1, 2)]
    assert rows(C.row_count_difference(ours, vendor)) == [(-1.0,)]


def test_first_mismatches_are_in_time_order_without_nulls(spark):
    ours, vendor, minutes = reconciled(spark)
    got = [tuple(r) for r in C.first_mismatches(ours, vendor, n=3).collect()]
    assert got == [(minutes[1], 11, 10.0, 1.0), (minutes[3], 0, 12.0, -12.0), (minutes[5], 15, 14.0, 1.0)]


def test_equal_sides_pass(spark):
    ours, _, _ = reconciled(spark)
    same = ours.groupBy(F.col("DETECTION_DATE_TIME").alias("dt")).agg(F.max("NUMBER_CLICKS_TOTAL").alias("nall_m"))
    assert C.reconcile(ours, same).collect()[0].verdict == "PASS"


def many_days(spark, n_days, change=None):
    """Both sides over days of 24 minutes; ``change`` may edit the vendor's row of (day, minute)."""
    ours, vendor = [], []
    for d in range(n_days):
        for m in range(24):
            t = dt.datetime(2024, 1, 1) + dt.timedelta(days=d, minutes=m)
            ours += [("r", t, d + m, q) for q in ("Hi", "Mod", "Lo")]
            row = ("r", t, d + m)
            vendor += [row] if change is None else change(d, m, row)
    return (
        spark.createDataFrame(ours, "rec string, DETECTION_DATE_TIME timestamp_ntz, NUMBER_CLICKS_TOTAL long, QUALITY string"),
        spark.createDataFrame(vendor, "rec string, dt timestamp_ntz, nall_m long"),
    )


CHANGES = {
    "one count": lambda d, m, r: [(r[0], r[1], r[2] + (d == 700 and m == 3))],
    "two counts that add up to the same": lambda d, m, r: [(r[0], r[1], r[2] + (d == 700) * ((m == 3) - (m == 4)))],
    "a minute less": lambda d, m, r: [] if (d, m) == (700, 3) else [r],
    "a minute twice": lambda d, m, r: [r, r] if (d, m) == (700, 3) else [r],
    "a minute elsewhere": lambda d, m, r: [(r[0], r[1] + dt.timedelta(hours=(d, m) == (700, 3)), r[2])],
    "no count": lambda d, m, r: [(r[0], r[1], None if (d, m) == (700, 3) else r[2])],
}


@pytest.mark.parametrize("change", CHANGES)
def test_of_a_thousand_days_one_is_compared_row_by_row(spark, change):
    ours, vendor = many_days(spark, 1000, CHANGES[change])
    left = C.narrowed(ours, vendor, ("rec",))
    assert left.days.count() == 1000 and left.days.filter("differs").count() == 1
    assert left.ours.count() == 72 and 23 <= left.vendor.count() <= 25
    both = C.by_minute(ours, vendor, ("rec",))
    want = both.filter("nall_diff <> 0")
    assert rows(C.mismatches(ours, vendor, ("rec",))) == rows(want)
    missing = both.agg(F.count_if(F.col("our_nall").isNull()), F.count_if(F.col("vendor_nall").isNull()))
    assert rows(C.missing_minutes(ours, vendor, ("rec",))) == rows(missing)


def test_days_without_counts_keys_or_times_are_compared_row_by_row(spark):
    t = dt.datetime(2024, 1, 1)
    ours = spark.createDataFrame(
        [(k, s, n, q) for k, s, n in (("a", t, None), ("b", None, 4), (None, t, 4), ("c", t, 4)) for q in "123"],
        "rec string, DETECTION_DATE_TIME timestamp_ntz, NUMBER_CLICKS_TOTAL long, QUALITY string",
    )
    vendor = spark.createDataFrame([("a", t, 0), ("b", None, 4), (None, t, 4), ("c", t, 4)], "rec string, dt timestamp_ntz, nall_m long")
    both = C.by_minute(ours, vendor, ("rec",))
    missing = both.agg(F.count_if(F.col("our_nall").isNull()), F.count_if(F.col("vendor_nall").isNull()))
    assert rows(C.missing_minutes(ours, vendor, ("rec",))) == rows(missing)
    assert rows(C.narrowed(ours, vendor, ("rec",)).days.filter("NOT differs"), "rec") == [("c",)]


def real_peak(raw, ipi, extended):
    """Plain form of the amplitude rule, step by step over rising peaks."""
    raw = max(raw, 2)
    if not extended:
        return raw
    if raw > 222 and 10 <= ipi <= 256:
        ceiling, over, value = 50 * ipi, False, None
        for peak in range(223, raw + 1):
            rise = 32 + (231 - peak) * 4 if peak < 232 else 16 + (239 - peak) * 2 if peak < 240 else 255 - peak
            curve = float("inf") if rise == 0 else int((4000 / ipi) ** -0.75 * 10 ** (5.24 * rise**-0.11) + 0.5)
            over = over or curve > ceiling
            value = min(ceiling, max(384, ceiling if over else curve))
        return value
    return raw * 2 if raw < 128 else raw + 128


def test_amplitude_table_equals_the_plain_rule(spark):
    data = [(raw, ipi, e) for raw in [0, 1, 2, 127, 128, 222, *range(223, 256)] for ipi in [1, 9, *range(10, 257, 9), 256, 300] for e in (True, False)]
    df = spark.createDataFrame(data, "raw_peak int, ipi int, has_extended_amps boolean")
    got = Counter(tuple(r) for r in A.with_real_amplitude(df).select("raw_peak", "ipi", "has_extended_amps", "real_peak").collect())
    assert got == Counter((r, i, e, real_peak(r, i, e)) for r, i, e in data)
    assert A.clipped_amplitudes(spark).count() == 33 * 247


def test_a_long_grid_is_made_by_several_tasks(spark):
    """Its blocks are few bytes until they are exploded, which adaptive execution would take for work of one task."""
    grid = G.time_grid(spans(spark, end=30 * 86_400), "second")
    per_task = grid.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()
    assert sum(r["n"] for r in per_task) == 30 * 86_400 + 1
    assert len(per_task) > 1

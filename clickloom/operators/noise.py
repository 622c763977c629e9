"""F-POD clicks per minute that pass the amplitude and frequency limits."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clickloom import layout as L
from clickloom.functions import amplitude as A
from clickloom.operators.ordering import earlier_runs
from clickloom.operators.segment import MINUTE, boundaries, markers, segment

# Limits of the filter (fixed values).
AMPLITUDE_ABOVE = 11
KHZ_RANGE = (21, 221)


def keep_passing(
    records: DataFrame, by_duration: bool = False, above: int = AMPLITUDE_ABOVE, khz: tuple[int, int] = KHZ_RANGE
) -> DataFrame:
    """Markers and the click records within the limits: a narrow filter ahead of any shuffle.

    Needs b4, b7, b11, b14, b15 and has_extended_amps.
    """
    values = records.withColumns(
        {"click_ipi": F.col("b7").cast("int") + 1, "click_raw": F.col("b11").cast("int")}
    )
    frequency = A.peak_khz(F.col("click_ipi"))
    if by_duration:
        duration = A.click_duration(F.col("b14").cast("int"), F.col("b15").cast("int"))
        frequency = A.duration_khz(F.col("click_ipi"), F.col("b4").cast("int"), duration)
    passes = (F.col("real_peak") > above) & frequency.between(*khz)
    is_click = F.col("rec_type") <= L.LAST_FPOD_CLICK_TYPE
    # Rows that report a range that cannot be read have no type and go on.
    return (
        A.with_real_amplitude(values, "click_raw", "click_ipi")
        .filter((F.col("rec_type") == L.MARKER) | (is_click & passes) | F.col("rec_type").isNull())
        .drop("click_ipi", "click_raw", "real_peak")
    )


def filtered_click_counts(records: DataFrame, by_duration: bool = False) -> DataFrame:
    """Passing clicks of every minute of a record table, empty minutes included."""
    minutes = markers(segment(boundaries(records))).select("pod_file", F.col("marker_no").alias("minute_no"))
    cut = segment(keep_passing(records, by_duration).select("pod_file", "rec_no", "rec_type"))
    inside = cut.filter((F.col("seg_no") >= 1) & (F.col("rec_type") != L.MARKER))
    counts = inside.groupBy("pod_file", F.col("seg_no").alias("minute_no")).agg(F.count("*").alias("nall"))
    return minutes.join(counts, MINUTE, "left").na.fill(0, ["nall"])


def counts_by_split(records: DataFrame, by_duration: bool = False) -> DataFrame:
    """Passing clicks per file split and marker of the split: one pass, reduced before any shuffle.

    Rows with ``error`` stay apart, so that rows and status come from the same table.
    """
    return (
        keep_passing(records, by_duration)
        .groupBy("pod_file", "split", "markers", "error")
        .agg(F.count_if(F.col("rec_type") != L.MARKER).alias("nall"))
    )


def counts_by_minute(split_counts: DataFrame) -> DataFrame:
    """Minutes from the counts of all splits; what lies before the first marker of a file goes."""
    totals = split_counts.groupBy("pod_file", F.col("split").alias("run")).agg(F.max("markers").alias("_m"))
    before = totals.select(
        "pod_file",
        F.col("run").alias("split"),
        F.coalesce(F.sum("_m").over(earlier_runs(["pod_file"])), F.lit(0)).alias("_before"),
    )
    minute = F.col("_before") + F.col("markers")
    return (
        split_counts.join(before, ["pod_file", "split"])
        .groupBy("pod_file", minute.alias("minute_no"))
        .agg(F.sum("nall").alias("nall"))
        .filter("minute_no >= 1")
    )

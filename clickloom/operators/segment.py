"""Minutes of a recording: records cut by minute markers, minute attributes, click totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from clickloom import layout as L
from clickloom.functions import records as R
from clickloom.operators.ordering import RUN_ROWS, earlier_runs, with_run

FILE = ["pod_file"]
MINUTE = ["pod_file", "minute_no"]


def boundaries(records: DataFrame) -> DataFrame:
    """Marker and end-of-file records: about one row per recorded minute."""
    return records.filter(F.col("rec_type").isin(L.MARKER, L.END_OF_FILE))


def _run_totals(runs: DataFrame, counters: dict[str, Column]) -> DataFrame:
    end = F.min(F.when(F.col("rec_type") == L.END_OF_FILE, F.col("rec_no")))
    marker = F.sum((F.col("rec_type") == L.MARKER).cast("long"))
    if counters:
        marker = F.max("_m")
    held = [F.max(f"{p}{n}").alias(f"{p}{n}") for n in counters for p in ("_n_", "_at_")]
    return runs.groupBy("pod_file", "run").agg(
        marker.alias("_m"), F.max("rec_no").alias("_last"), end.alias("_end"), *held
    )


def _offsets(totals: DataFrame, counters: dict[str, Column]) -> DataFrame:
    """Per run: markers and flagged records before it; per file: its end."""
    before, whole = earlier_runs(FILE), W.partitionBy(*FILE)
    offsets = totals.select(
        "pod_file",
        "run",
        F.coalesce(F.sum("_m").over(before), F.lit(0)).alias("_m_before"),
        F.min("_end").over(whole).alias("_end_at"),
        F.max("_last").over(whole).alias("_last_at"),
        *[F.coalesce(F.sum(f"_n_{n}").over(before), F.lit(0)).alias(f"_before_{n}") for n in counters],
        *[F.col(f"_at_{n}") for n in counters],
    )
    for name in counters:
        # Flagged records of the file up to the last marker of an earlier run.
        up_to = F.col(f"_before_{name}") + F.col(f"_at_{name}")
        offsets = offsets.withColumn(f"_held_{name}", F.max(up_to).over(before)).drop(f"_at_{name}")
    return offsets


def run_offsets(bounds: DataFrame, file_ends: DataFrame, run_rows: int = RUN_ROWS) -> DataFrame:
    """Offsets of every run of a file from its boundaries and last record number alone.

    With them :func:`segment` reads the records once.
    """
    sparse = _run_totals(with_run(bounds, run_rows=run_rows), {}).drop("_last")
    last_run = F.expr(f"last_rec div {run_rows}")
    dense = file_ends.select(
        "pod_file",
        F.col("last_rec").alias("_last"),
        F.explode(F.sequence(F.lit(0).cast("long"), last_run)).alias("run"),
    )
    return _offsets(dense.join(sparse, ["pod_file", "run"], "left").na.fill(0, ["_m"]), {})


def segment(
    records: DataFrame,
    counters: dict[str, Column] | None = None,
    offsets: DataFrame | None = None,
    stop_at_end: bool = False,
    run_rows: int = RUN_ROWS,
) -> DataFrame:
    """Number every record by the minute markers at or before it in its file.

    Adds ``run`` (by which the rows stay partitioned), ``seg_no`` (markers so far), ``last_rec`` (last record number of the file) and, for each
    counter, ``pos_<name>``: how many flagged records lie between the last marker and this record,
    this record included. With ``stop_at_end`` a file ends before its first end-of-file record.

    A file may hold any share of all rows: windows run inside runs of ``run_rows`` records, and
    once more over the table of run totals. Without ``offsets`` the totals take a pass of their own.
    Records and totals are merged: what a reader in Python returns is estimated by the size of its list of files, so
    that Spark may take the records for the smaller side and broadcast them.
    """
    counters = counters or {}
    marker = F.col("rec_type") == L.MARKER
    inside = W.partitionBy("pod_file", "run").orderBy("rec_no").rowsBetween(W.unboundedPreceding, 0)
    runs = with_run(records, run_rows=run_rows)
    # Flags first, then all running counts in one window step and what builds on them in a second.
    flags = {"_m": marker, **{f"_n_{n}": flag for n, flag in counters.items()}}
    flagged = runs.withColumns({c: flag.cast("long") for c, flag in flags.items()})
    local = flagged.withColumns({c: F.sum(c).over(inside) for c in flags})
    at_marker = {f"_at_{n}": F.when(marker, F.col(f"_n_{n}")) for n in counters}
    if counters:
        local = local.withColumns(at_marker).withColumns({c: F.max(c).over(inside) for c in at_marker})
    if offsets is None:
        offsets = _offsets(_run_totals(local if counters else runs, counters), counters)

    joined = local.join(offsets.hint("merge"), ["pod_file", "run"])
    if stop_at_end:
        joined = joined.filter(F.col("_end_at").isNull() | (F.col("rec_no") < F.col("_end_at")))
        last = F.coalesce(F.col("_end_at") - 1, F.col("_last_at"))
    else:
        last = F.col("_last_at")
    positions = [
        F.coalesce(
            F.col(f"_n_{n}") - F.col(f"_at_{n}"),
            F.col(f"_before_{n}") + F.col(f"_n_{n}") - F.col(f"_held_{n}"),
        ).alias(f"pos_{n}")
        for n in counters
    ]
    return joined.select(
        *records.columns, "run", (F.col("_m_before") + F.col("_m")).alias("seg_no"), last.alias("last_rec"), *positions
    )


def markers(segmented: DataFrame) -> DataFrame:
    """The minute marker records, numbered from 1 in each file."""
    return segmented.filter(F.col("rec_type") == L.MARKER).withColumnRenamed("seg_no", "marker_no")


def cpod_clicks(segmented: DataFrame) -> DataFrame:
    """C-POD clicks with their minute row: a click after marker j belongs to row j+1.

    Clicks before the first marker go. The last record of a file is either in the part after the
    last marker, which has no row, or it is the closing boundary of the tail minute, so it goes too.
    Rows past the last minute disappear in the join with the minutes.
    """
    return (
        segmented.filter((F.col("rec_type") < L.MARKER) & (F.col("seg_no") >= 1))
        .filter(F.col("rec_no") < F.col("last_rec"))
        .withColumn("minute_no", F.col("seg_no") + 1)
        .withColumnRenamed("rec_type", "train_id")
        .drop("seg_no", "last_rec")
    )


def marker_counts(marks: DataFrame) -> DataFrame:
    return marks.groupBy(*FILE).agg(F.max("marker_no").alias("n_markers"))


def with_tail(cp3_marks: DataFrame, cp1_markers: DataFrame) -> DataFrame:
    """One row per CP3 or CP1 file with ``n_markers`` and ``has_tail``; ``cp1_markers`` has pod_file and n_cp1.

    A CP3 file with fewer markers than its CP1 twin has one more minute, closed by its last record.
    Without a CP1 twin there is no tail.
    """
    n = F.coalesce("n_markers", F.lit(0).cast("long"))
    return marker_counts(cp3_marks).join(cp1_markers, FILE, "full_outer").select(
        "pod_file", n.alias("n_markers"), "n_cp1", F.coalesce(F.col("n_cp1") > n, F.lit(False)).alias("has_tail")
    )


def tail_files(cp3_marks: DataFrame, cp1_marks: DataFrame) -> DataFrame:
    return with_tail(cp3_marks, marker_counts(cp1_marks).withColumnRenamed("n_markers", "n_cp1"))


def cpod_minute_rows(cp3_marks: DataFrame, files: DataFrame) -> DataFrame:
    """Minute rows of C-POD files: row k carries the attributes of marker k-1, row 1 none.

    ``files`` needs ``n_markers`` and ``has_tail``; its columns are kept on every row.
    """
    shifted = cp3_marks.select(
        "pod_file", (F.col("marker_no") + 1).alias("minute_no"), *[F.col(c) for c in ("b4", "b5", "b9")]
    )
    rows = F.col("n_markers") + F.col("has_tail").cast("long")
    first = files.filter(rows >= 1).withColumn("minute_no", F.lit(1).cast("long"))
    later = shifted.join(files, FILE).filter(F.col("minute_no") <= rows)
    return first.unionByName(later, allowMissingColumns=True).select(
        *[c for c in files.columns],
        "minute_no",
        F.col("b9").alias("raw_clicks"),
        F.col("b5").alias("tilt"),
        F.coalesce(F.col("b4") / F.lit(5.0), F.lit(0.0)).alias("temperature"),
        F.coalesce(R.tilt_angle(F.col("b5")), F.lit(0.0)).alias("angle"),
    )


def with_minute_on(rows: DataFrame) -> DataFrame:
    """Recorder-on flag of C-POD minutes; the first minute of a file is always off."""
    flag = R.minute_on_cpod(F.col("tilt"), F.col("raw_clicks"), F.col("tilt_min"), F.col("tilt_max"))
    return rows.withColumn("minute_on", F.when(F.col("minute_no") == 1, 0).otherwise(flag))


def with_clock(rows: DataFrame, start: str = "start_time") -> DataFrame:
    """Time stamp of a minute row: whole minutes after the start of the file."""
    return rows.withColumn("minute_start", F.timestamp_add("MINUTE", F.col("minute_no") - 1, F.col(start)))


def fpod_minute_rows(marks: DataFrame) -> DataFrame:
    """Minute rows of F-POD files straight from their markers."""
    nall = F.col("b9").cast("long") * 256 + F.col("b10")
    return marks.select(
        "pod_file",
        F.col("marker_no").alias("minute_no"),
        F.col("b8").cast("double").alias("temperature"),
        F.round(R.tilt_angle(F.col("b4"))).alias("angle"),
        nall.alias("nall"),
        R.minute_on_fpod(nall).alias("minute_on"),
    )


def cp1_click_totals(bounds: DataFrame, file_ends: DataFrame, run_rows: int = RUN_ROWS) -> DataFrame:
    """Clicks logged in each CP1 minute, from marker positions alone.

    ``bounds`` holds only marker and end-of-file records, ``file_ends`` the last record number
    of each file. A minute spans its marker up to the next one; end-of-file records do not count.
    """
    ends = F.col("rec_type") == L.END_OF_FILE
    numbered = segment(bounds.select("pod_file", "rec_no", "rec_type"), {"end": ends}, run_rows=run_rows)
    marks = markers(numbered).select("pod_file", "marker_no", "rec_no")
    dropped = numbered.filter(ends).groupBy("pod_file", F.col("seg_no").alias("marker_no")).agg(
        F.count("*").alias("_dropped")
    )
    following = marks.select("pod_file", (F.col("marker_no") - 1).alias("marker_no"), F.col("rec_no").alias("_next"))
    return (
        marks.join(following, ["pod_file", "marker_no"], "left")
        .join(dropped, ["pod_file", "marker_no"], "left")
        .join(file_ends, FILE, "left")
        .select(
            "pod_file",
            F.col("marker_no").alias("minute_no"),
            (
                F.coalesce(F.col("_next"), F.col("last_rec") + 1)
                - F.col("rec_no")
                - 1
                - F.coalesce("_dropped", F.lit(0))
            ).alias("nall"),
        )
    )


def with_nall(rows: DataFrame, totals: DataFrame) -> DataFrame:
    """Attach CP1 click totals; minutes without a CP1 minute get NULL."""
    return rows.join(totals, MINUTE, "left")


def fpod_counters() -> dict[str, Column]:
    return {
        "train": F.col("rec_type") == L.TRAIN_DETAIL,
        "click": F.col("rec_type") <= L.LAST_FPOD_CLICK_TYPE,
    }


def zip_by_position(segmented: DataFrame, need_click: bool = False) -> DataFrame:
    """The i-th train record of an F-POD minute describes its i-th click record.

    Both records of a pair share file, minute and position, so the zip is an aggregate over groups of
    two, in one pass instead of a self-join. ``segmented`` needs the counters of
    :func:`fpod_counters`. A train record without click keeps a NULL time unless ``need_click``.
    """
    detail = F.col("rec_type") == L.TRAIN_DETAIL
    click = F.col("rec_type") <= L.LAST_FPOD_CLICK_TYPE
    pairs = (
        segmented.filter((F.col("seg_no") >= 1) & (detail | click))
        .groupBy(
            "pod_file",
            F.col("seg_no").alias("minute_no"),
            F.when(detail, F.col("pos_train")).otherwise(F.col("pos_click")).alias("pos"),
        )
        .agg(
            F.max(F.when(detail, F.col("rec_no"))).alias("rec_no"),
            F.max(F.when(detail, F.col("b16"))).alias("train_id"),
            F.max(F.when(detail, F.col("b15"))).alias("class_byte"),
            F.max(F.when(click, F.col("time_us"))).alias("time_us"),
        )
        .filter(F.col("rec_no").isNotNull())
    )
    return pairs.filter(F.col("time_us").isNotNull()) if need_click else pairs

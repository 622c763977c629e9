"""Detection rows: one per minute and quality, labelled and clipped to the deployment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clickloom import layout as L
from clickloom.operators.trains import COUNT_COLUMNS, SPAN_COLUMNS

SPECIES = "NBHF"
OUTPUT_COLUMNS = (
    "DETECTION_DATE_TIME",
    "TEMPERATURE",
    "ANGLE",
    "NUMBER_CLICKS_TOTAL",
    "filename",
    "QUALITY",
    "NUMBER_CLICKS_FILTERED",
    "DPM",
    "MILLISECONDS",
    "BPM",
    "TIME_LOST_PERCENTAGE",
    "SPECIES",
    "RECORDED",
)
# Output label and the suffix of the per-minute columns.
QUALITY_ROWS = (("Hi", "Hi"), ("Mod", "Med"), ("Lo", "Low"))


def time_lost(nall: Column) -> Column:
    return F.coalesce((nall > L.LOST_MINUTE_ABOVE).cast("int"), F.lit(0))


def recorded(nall: Column, angle: Column) -> Column:
    """``angle`` in whole degrees."""
    return F.coalesce(((nall > 0) & (angle < L.RECORDED_BELOW_ANGLE)).cast("int"), F.lit(0))


def milliseconds(us: Column) -> Column:
    return F.round(us * F.lit(0.001)).cast("long")


def by_quality(minutes: DataFrame) -> DataFrame:
    """Three rows per minute. One pass over the row instead of a self-join or union."""
    rows = [
        F.struct(
            F.lit(label).alias("QUALITY"),
            F.col(f"click{q}").alias("NUMBER_CLICKS_FILTERED"),
            (F.col(f"click{q}") != 0).cast("int").alias("DPM"),
            milliseconds(F.col(f"us{q}")).alias("MILLISECONDS"),
            F.col(f"buzz{q}").alias("BPM"),
        )
        for label, q in QUALITY_ROWS
    ]
    spread = [*COUNT_COLUMNS, *SPAN_COLUMNS]
    return minutes.select(*[c for c in minutes.columns if c not in spread], F.inline(F.array(*rows)))


def fill_empty_minutes(minutes: DataFrame, counts: DataFrame, minute: str = "minute_no") -> DataFrame:
    """Every minute row, with zero counts where it has no train."""
    return minutes.join(counts, ["pod_file", minute], "left").na.fill(0, [*COUNT_COLUMNS, *SPAN_COLUMNS])


def output_rows(minutes: DataFrame) -> DataFrame:
    """The 13 output columns from filled minutes with minute_start, temperature, angle and nall."""
    angle = F.round("angle")
    return by_quality(minutes).select(
        F.col("minute_start").alias("DETECTION_DATE_TIME"),
        F.round("temperature").alias("TEMPERATURE"),
        angle.alias("ANGLE"),
        F.col("nall").alias("NUMBER_CLICKS_TOTAL"),
        F.col("pod_file").alias("filename"),
        "QUALITY",
        "NUMBER_CLICKS_FILTERED",
        "DPM",
        "MILLISECONDS",
        "BPM",
        time_lost(F.col("nall")).alias("TIME_LOST_PERCENTAGE"),
        F.lit(SPECIES).alias("SPECIES"),
        recorded(F.col("nall"), angle).alias("RECORDED"),
    )


def relabel(detections: DataFrame, files: DataFrame) -> DataFrame:
    """Keep the file name as ``PODfile``, put the deployment id into ``filename``.

    ``files`` has one row per file name (without extension): pod_file, deployment_id, deploy, valid_until. A
    ``family`` on both sides tells files of equal name apart.
    """
    keys = ["PODfile", *(["family"] if "family" in detections.columns and "family" in files.columns else [])]
    return (
        detections.withColumnRenamed("filename", "PODfile")
        .join(files.withColumnRenamed("pod_file", "PODfile"), keys)
        .withColumnRenamed("deployment_id", "filename")
    )


def clip(detections: DataFrame, time: str = "DETECTION_DATE_TIME") -> DataFrame:
    """Rows from deployment to end of valid data, both ends included."""
    return detections.filter(F.col(time).between(F.col("deploy"), F.col("valid_until")))


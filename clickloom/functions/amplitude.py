"""Amplitude and frequency of F-POD clicks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Fixed values of the clipped-amplitude rule.
FIRST_CLIPPED_PEAK = 223
LAST_PEAK = 255
IPI_RANGE = (10, 256)
CEILING_PER_IPI = 50
FLOOR_AMPLITUDE = 384


def _rise_time(peak: Column) -> Column:
    """Rise time code of a clipped peak: three ramps, steps 4, 2 and 1 (fixed values)."""
    return (
        F.when(peak < 232, 32 + (231 - peak) * 4).when(peak < 240, 16 + (239 - peak) * 2).otherwise(255 - peak)
    )


def clipped_amplitudes(spark: SparkSession) -> DataFrame:
    """Real amplitude for every (raw peak 223-255, inter-peak interval 10-256): 8,151 rows.

    The curve falls with rising rise-time code, so it grows with the peak; from the first peak
    that passes the ceiling on, the ceiling holds.
    """
    peaks = F.explode(F.sequence(F.lit(FIRST_CLIPPED_PEAK), F.lit(LAST_PEAK)))
    ipis = F.explode(F.sequence(F.lit(IPI_RANGE[0]), F.lit(IPI_RANGE[1])))
    grid = spark.range(1).select(peaks.alias("raw_peak")).select("raw_peak", ipis.alias("ipi"))
    rise = _rise_time(F.col("raw_peak")).cast("double")
    # Fixed values of the curve.
    curve = F.round(F.pow(4000.0 / F.col("ipi"), -0.75) * F.pow(F.lit(10.0), 5.24 * F.pow(rise, -0.11)))
    ceiling = F.col("ipi") * CEILING_PER_IPI
    # Rise time 0 means an infinite curve value, hence the ceiling.
    value = F.when(rise == 0, ceiling).otherwise(F.least(curve, ceiling))
    return grid.select(
        "raw_peak",
        "ipi",
        F.least(ceiling, F.greatest(F.lit(FLOOR_AMPLITUDE), value)).cast("int").alias("clipped"),
    )


def with_real_amplitude(
    clicks: DataFrame, raw: str = "raw_peak", ipi: str = "ipi", extended: str = "has_extended_amps"
) -> DataFrame:
    """Add ``real_peak``; the lookup is a table of 8,151 rows, so broadcasting it is bounded."""
    table = F.broadcast(
        clipped_amplitudes(clicks.sparkSession).select(
            F.col("raw_peak").alias("_raw"), F.col("ipi").alias("_ipi"), "clipped"
        )
    )
    floor = F.greatest(F.col(raw), F.lit(2))
    plain = F.when(floor < 128, floor * 2).otherwise(floor + 128)
    return (
        clicks.join(table, (F.col("_raw") == F.col(raw)) & (F.col("_ipi") == F.col(ipi)), "left")
        .withColumn("real_peak", F.when(F.col(extended), F.coalesce("clipped", plain)).otherwise(floor).cast("int"))
        .drop("_raw", "_ipi", "clipped")
    )


def peak_khz(ipi: Column) -> Column:
    """Frequency from the interval at the loudest cycle."""
    return F.round(4000.0 / ipi).cast("int")


def click_duration(high: Column, low: Column) -> Column:
    """12-bit duration: upper nibble of one byte over a full byte."""
    return F.shiftleft(high.bitwiseAND(F.lit(240)), 4).bitwiseOR(low)


def duration_khz(ipi: Column, cycles: Column, duration: Column) -> Column:
    """Frequency from cycle count and duration; falls back to the interval beyond 30 kHz apart."""
    peak = peak_khz(ipi)
    span = F.nullif(duration, F.lit(0))
    own = (
        F.when((cycles >= 5) & (cycles < 16) & (duration >= 100), F.round(4000.0 * (cycles - 3) / span))
        .when((cycles >= 16) & (duration >= 100), F.round(60000.0 / span))
        .otherwise(peak)
        .cast("int")
    )
    return F.when(F.abs(own - peak) > 30, peak).otherwise(own)

"""Counts per time bin on a gap-free grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

UNITS = {"second": 1, "minute": 60, "hour": 3600}
SPECIES = "NBHF"
POOLED_QUALITY = 3
# Bins per generated array: one day of seconds.
GRID_BLOCK = 86_400
# Bins of a recording that are filled together; an array of gaps is never longer.
RUN_BINS = 32_768


class NoDetections(ValueError):
    """The input holds at most one click."""


def truncate(unit: str, time: Column) -> Column:
    return F.date_trunc(unit, time).cast("timestamp_ntz")


def high_and_moderate(clicks: DataFrame) -> DataFrame:
    return clicks.filter(F.col("quality").isin(2, 3))


def only_species(df: DataFrame, species: str = SPECIES) -> DataFrame:
    return df.filter(F.col("species") == species)


def clicks_per_species(clicks: DataFrame, unit: str, keys: list[str]) -> DataFrame:
    """Clicks and summed duration per bin and species."""
    return clicks.groupBy(*keys, truncate(unit, F.col("time")).alias("time"), "species").agg(
        F.count("*").alias("nclicks"), F.sum("duration").alias("duration")
    )


def clicks_per_bin(clicks: DataFrame, unit: str, keys: list[str]) -> DataFrame:
    return clicks.groupBy(*keys, truncate(unit, F.col("time")).alias("time")).agg(F.count("*").alias("nclicks"))


def time_grid(spans: DataFrame, unit: str, start: str = "start", end: str = "end") -> DataFrame:
    """Every bin from start (cut to the unit) to end, for each row of ``spans``.

    Blocks first, then the bins of a block, so that no row ever holds the bins of a whole deployment. The blocks are dealt
    to a given number of tasks: adaptive execution would put all of them into one, because blocks are small until they are
    exploded.
    """
    step = UNITS[unit]
    first = F.unix_seconds(truncate(unit, F.col(start)).cast("timestamp"))
    last = F.unix_seconds(F.col(end).cast("timestamp"))
    bins = F.floor((last - first) / step)
    rest = [c for c in spans.columns if c not in (start, end)]
    blocks = (
        spans.filter(F.col(end) >= F.col(start))
        .withColumn("_first", first)
        .withColumn("_bins", bins)
        .withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("_bins") / GRID_BLOCK))))
    )
    low = F.col("_block") * GRID_BLOCK
    high = F.least(F.col("_bins"), low + GRID_BLOCK - 1)
    tasks = int(spans.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return blocks.repartition(tasks, *rest, "_block").select(
        *rest, "_first", F.explode(F.sequence(low, high)).alias("_bin")
    ).select(*rest, F.timestamp_seconds(F.col("_first") + F.col("_bin") * step).cast("timestamp_ntz").alias("time"))


def species_seen(clicks: DataFrame, keys: list[str]) -> DataFrame:
    """Species of each recording as an array; the class nibble allows at most 16."""
    return clicks.groupBy(*keys).agg(F.collect_set("species").alias("_species"))


def species_grid(spans: DataFrame, clicks: DataFrame, unit: str, keys: list[str]) -> DataFrame:
    """Time grid for every species seen in the recording, filtered by quality or not."""
    seen = spans.join(species_seen(clicks, keys), keys)
    return time_grid(seen, unit).select(*keys, "time", F.explode("_species").alias("species"))


def fill_gaps(grid: DataFrame, counts: DataFrame, on: list[str], zeros: list[str]) -> DataFrame:
    """Full outer join of grid and counts; missing counts become 0. For grids that are tables; see :func:`fill_between`."""
    return grid.join(counts, on, "full_outer").na.fill(0, zeros)


def fill_between(
    spans: DataFrame, counts: DataFrame, unit: str, keys: list[str], zeros: list[str], start: str = "start", end: str = "end"
) -> DataFrame:
    """Counts of each bin, and zeros for the bins from start (cut to the unit) to end that have none.

    No grid is made and nothing is joined. The span of a recording is cut into runs of ``RUN_BINS`` bins; a run has its
    counted bins and one row that stands before its first bin, and each of these rows gives the empty bins up to the
    next. So a window holds one run, an array of bins is never longer, and a recording of years is spread over its runs.
    Counted bins outside the span stay. ``spans`` has one row for each value of ``keys``.
    """
    step = UNITS[unit]
    run = lambda bin: F.floor(bin / F.lit(RUN_BINS))
    low = F.floor(F.unix_seconds(truncate(unit, F.col(start)).cast("timestamp")) / step)
    high = F.floor(F.unix_seconds(F.col(end).cast("timestamp")) / step)
    edges = spans.filter(F.col(end) >= F.col(start)).select(*keys, low.alias("_low"), high.alias("_high"))
    edges = edges.withColumn("_run", F.explode(F.sequence(run(F.col("_low")), run(F.col("_high")))))
    edges = edges.withColumn("_bin", F.greatest(F.col("_low"), F.col("_run") * RUN_BINS) - 1)
    # The last bin that this run has to fill.
    edges = edges.withColumn("_high", F.least(F.col("_high"), F.col("_run") * RUN_BINS + (RUN_BINS - 1)))
    counted = counts.withColumn("_bin", F.floor(F.unix_seconds(F.col("time").cast("timestamp")) / step))
    counted = counted.select(*keys, run(F.col("_bin")).alias("_run"), "_bin", *zeros, F.lit(True).alias("_counted"))
    rows = counted.unionByName(edges.drop("_low"), allowMissingColumns=True)
    whole = W.partitionBy(*keys, "_run")
    rows = rows.select(
        "*", F.lead("_bin").over(whole.orderBy("_bin")).alias("_next"), F.max("_high").over(whole).alias("_until"),
        F.max(F.when(F.col("_counted").isNull(), F.col("_bin"))).over(whole).alias("_edge"),
    )
    first = F.greatest("_bin", "_edge") + 1
    last = F.least(F.coalesce(F.col("_next") - 1, F.col("_until")), F.col("_until"))
    none = F.array().cast("array<bigint>")
    gap = F.when(F.col("_until").isNotNull() & (first <= last), F.sequence(first, last)).otherwise(none)
    own = F.when(F.col("_counted"), F.array("_bin")).otherwise(none)
    filled = rows.select(
        *keys, *(F.col(z).alias(f"_{z}") for z in zeros), "_bin", "_counted", F.explode(F.concat(own, gap)).alias("_at")
    )
    # A row's own bin and no other; it alone may have no time at all.
    held = F.col("_counted") & F.col("_at").eqNullSafe(F.col("_bin"))
    return filled.select(
        *keys,
        F.timestamp_seconds(F.col("_at") * step).cast("timestamp_ntz").alias("time"),
        *(F.coalesce(F.when(held, F.col(f"_{z}")), F.lit(0)).cast(counts.schema[z].dataType).alias(z) for z in zeros),
    )


def species_spans(spans: DataFrame, clicks: DataFrame, keys: list[str]) -> DataFrame:
    """The span of each recording once for each species seen in it."""
    seen = spans.join(species_seen(clicks, keys), keys)
    return seen.select(*spans.columns, F.explode("_species").alias("species"))


def hour_rollup(per_minute: DataFrame, keys: list[str]) -> DataFrame:
    """Per hour and species: train time, positive minutes and the positive-hour flag."""
    return (
        per_minute.groupBy(*keys, truncate("hour", F.col("time")).alias("time"), "species")
        .agg(F.sum("milliseconds").alias("milliseconds"), F.sum("dpm").cast("long").alias("dpm"))
        .withColumn("dph", (F.col("dpm") > 0).cast("int"))
    )


def _require_clicks(clicks: DataFrame) -> None:
    if clicks.limit(2).count() <= 1:
        raise NoDetections("This file has no detections.")


def detection_positive(
    clicks: DataFrame,
    spans: DataFrame,
    unit: str,
    keys: list[str],
    only_nbhf: bool = True,
    strict: bool = False,
) -> DataFrame:
    """Detection-positive seconds, minutes or hours of each recording on a gap-free grid.

    ``clicks``: keys, time, species, quality, duration in seconds. ``spans``: keys, start, end.
    Qualities 2 and 3 are pooled and the result is tagged 3.
    """
    if strict:
        _require_clicks(clicks)
    base = "second" if unit == "second" else "minute"
    flag = "dps" if unit == "second" else "dpm"
    counts = clicks_per_species(high_and_moderate(clicks), base, keys)
    filled = fill_between(species_spans(spans, clicks, keys), counts, base, [*keys, "species"], ["nclicks", "duration"])
    rows = filled.withColumn(flag, (F.col("nclicks") > 0).cast("int")).withColumnRenamed("duration", "milliseconds")
    if unit == "hour":
        rows = hour_rollup(rows, keys)
    rows = rows.withColumn("milliseconds", F.col("milliseconds") * 1000).withColumn("quality", F.lit(POOLED_QUALITY))
    return only_species(rows) if only_nbhf else rows


def click_counts(
    clicks: DataFrame, spans: DataFrame, unit: str, keys: list[str], strict: bool = False
) -> DataFrame:
    """Clicks per bin with zeros for empty bins."""
    if strict:
        _require_clicks(clicks)
    return fill_between(spans, clicks_per_bin(clicks, unit, keys), unit, keys, ["nclicks"])


def with_noise(detections: DataFrame, noise: DataFrame, keys: list[str]) -> DataFrame:
    """Detection bins with the click total of the same bin."""
    return detections.join(noise.withColumnRenamed("nclicks", "nall"), [*keys, "time"])

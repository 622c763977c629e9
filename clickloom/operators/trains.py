"""Click trains: per-train facts, per-minute counts, click arrays.

Every step first reduces inside runs of record numbers, so a train or minute of any size is
spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from clickloom import layout as L
from clickloom.functions import records as R
from clickloom.operators.ordering import RUN_ROWS, earlier_runs, with_run

SPECIES_NBHF = 0
QUALITIES = {"Hi": 3, "Med": 2, "Low": 1, "All": 0}
# Clicks per row in the array form; more than any recorder stores for one minute.
SEGMENT_CLICKS = 65_536


def with_interval(
    clicks: DataFrame, minute: str = "minute_no", run_rows: int = RUN_ROWS
) -> DataFrame:
    """Add ``ici_us``, the time since the previous click of the train in record order, and ``run``."""
    keys = ["pod_file", minute, "train_id"]
    runs = with_run(clicks, run_rows=run_rows)
    inside = W.partitionBy(*keys, "run").orderBy("rec_no")
    over_runs = W.partitionBy(*keys).orderBy("run")
    ends = runs.groupBy(*keys, "run").agg(F.max_by("time_us", "rec_no").alias("_end"))
    carried = ends.select(*keys, "run", F.lag("_end").over(over_runs).alias("_carried"))
    previous = F.coalesce(F.lag("time_us").over(inside), F.col("_carried"))
    # The window sees the joined rows, so the first click of a run takes the carried time.
    return (
        runs.join(carried, [*keys, "run"])
        .withColumn("ici_us", F.col("time_us") - previous)
        .drop("_carried")
    )


def train_facts(clicks: DataFrame, minute: str = "minute_no", run_rows: int = RUN_ROWS) -> DataFrame:
    """One row per train: class byte of its first record, click count, first and last time, least interval.

    The runs of one train are reduced first; only their edges meet again.
    """
    keys = ["pod_file", minute, "train_id"]
    runs = with_run(clicks, run_rows=run_rows)
    # Co-locate by run, so that the window and the first aggregate share one shuffle.
    inside = W.partitionBy("pod_file", "run", minute, "train_id").orderBy("rec_no")
    parts = (
        runs.withColumn("_ici", F.col("time_us") - F.lag("time_us").over(inside))
        .groupBy(*keys, "run")
        .agg(
            F.min_by("class_byte", "rec_no").alias("_class"),
            F.min("rec_no").alias("_first_rec"),
            F.count("*").alias("_n"),
            F.count("time_us").alias("_timed"),
            F.min_by("time_us", "rec_no").alias("_first"),
            F.max_by("time_us", "rec_no").alias("_last"),
            F.min("_ici").alias("_ici"),
        )
    )
    over_runs = W.partitionBy(*keys).orderBy("run")
    edge = F.col("_first") - F.lag("_last").over(over_runs)
    return (
        parts.withColumn("_edge", edge)
        .groupBy(*keys)
        .agg(
            F.min_by("_class", "run").alias("class_byte"),
            F.min("_first_rec").alias("first_rec"),
            F.sum("_n").alias("no_of_clicks"),
            F.min_by("_first", "run").alias("first_us"),
            F.max_by("_last", "run").alias("last_us"),
            F.min(F.least("_ici", "_edge")).alias("min_ici_us"),
        )
    )


def with_class(trains: DataFrame, family: str = "CP") -> DataFrame:
    fields = R.cpod_class(F.col("class_byte")) if family == "CP" else R.fpod_class(F.col("class_byte"))
    return trains.withColumns(fields)


def minute_counts(
    trains: DataFrame, minute: str = "minute_no", need_species_good: bool = False, buzz_us: int = L.BUZZ_US
) -> DataFrame:
    """Per minute: trains, clicks, and per quality of the NBHF class trains, clicks, train time, buzz flag.

    F-POD counts also need the species-good flag; train time and the buzz flag do not.
    """
    nbhf = F.col("species_class") == SPECIES_NBHF
    counted = nbhf & (F.col("species_good") == 1) if need_species_good else nbhf

    def n_trains(code: int) -> Column:
        return F.count_if(counted & (F.col("quality_class") == code))

    def total(value: Column, keep: Column) -> Column:
        return F.coalesce(F.sum(F.when(keep, value)), F.lit(0))

    aggregates = [F.count("*").alias("no_of_trains"), F.sum("no_of_clicks").alias("no_of_clicks")]
    for name, code in QUALITIES.items():
        of_quality = F.col("quality_class") == code
        aggregates.append(n_trains(code).alias(f"train{name}"))
        aggregates.append(total(F.col("no_of_clicks"), counted & of_quality).alias(f"click{name}"))
        if code:
            span = F.col("last_us") - F.col("first_us")
            buzz = F.coalesce(F.col("min_ici_us") < buzz_us, F.lit(False))
            aggregates.append(total(span, nbhf & of_quality).alias(f"us{name}"))
            aggregates.append(F.max(F.when(nbhf & of_quality & buzz, 1).otherwise(0)).alias(f"buzz{name}"))
    return trains.groupBy("pod_file", minute).agg(*aggregates)


COUNT_COLUMNS = ["no_of_trains", "no_of_clicks"] + [f"{k}{q}" for q in QUALITIES for k in ("train", "click")]
SPAN_COLUMNS = [f"{k}{q}" for q in ("Hi", "Med", "Low") for k in ("us", "buzz")]


def click_arrays(
    clicks: DataFrame,
    values: list[str],
    minute: str = "minute_no",
    segment_clicks: int = SEGMENT_CLICKS,
    run_rows: int = RUN_ROWS,
) -> DataFrame:
    """Clicks of each train as arrays in record order, with the class byte of its first record and its click count.

    A row holds at most ``segment_clicks`` clicks; a longer train continues in rows with the next
    ``segment_no``, so no array grows with the data and no click is lost. ``ici_us`` has one entry
    per click after the first of the train.
    """
    keys = ["pod_file", minute, "train_id"]
    runs = with_run(clicks, run_rows=run_rows)
    totals = runs.groupBy(*keys, "run").agg(
        F.count("*").alias("_n"),
        F.max_by("time_us", "rec_no").alias("_end"),
        F.min_by("class_byte", "rec_no").alias("_class"),
    )
    over_runs, whole = W.partitionBy(*keys).orderBy("run"), W.partitionBy(*keys)
    offsets = totals.select(
        *keys,
        "run",
        F.coalesce(F.sum("_n").over(earlier_runs(keys)), F.lit(0)).alias("_before"),
        F.lag("_end").over(over_runs).alias("_carried"),
        F.sum("_n").over(whole).alias("no_of_clicks"),
        F.min_by("_class", "run").over(whole).alias("_class"),
    )
    inside = W.partitionBy(*keys, "run").orderBy("rec_no")
    previous = F.coalesce(F.lag("time_us").over(inside), F.col("_carried"))
    placed = runs.join(offsets, [*keys, "run"]).withColumns(
        {"pos": F.row_number().over(inside) + F.col("_before"), "ici_us": F.col("time_us") - previous}
    )
    grouped = (
        placed.withColumn("segment_no", F.expr(f"(pos - 1) div {segment_clicks}"))
        .groupBy(*keys, "segment_no")
        .agg(
            F.sort_array(F.collect_list(F.struct("pos", *values, "ici_us"))).alias("_rows"),
            F.first("no_of_clicks").alias("no_of_clicks"),
            F.first("_class").alias("class_byte"),
        )
    )
    return grouped.select(
        *keys,
        "segment_no",
        "no_of_clicks",
        "class_byte",
        *[F.col(f"_rows.{v}").alias(v) for v in values],
        F.filter(F.col("_rows.ici_us"), lambda x: x.isNotNull()).alias("ici_us"),
    )

"""Minutes and trains from what ranges of records know.

``rows`` are the rows of :func:`clickloom.sources.trains.read_trains`. Clicks of whole minutes are reduced where they
were read; only the loose records, of two minutes a range, are shuffled as records.

Everything that is known of a file as a whole (its ranges, end, header, raw twin and failures) comes into one row, by one
aggregate. Markers are numbered by adding what earlier ranges of the file hold, as that row tells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from clickloom.operators import trains as T
from clickloom.operators.ordering import number_in_groups
from clickloom.operators.segment import MINUTE
from clickloom.sources.trains import CLICK, ENDED, LOOSE_CLICK, LOOSE_TRAIN, MARK, RANGE

KEYS = ["pod_file", "split", "markers", "what", "train_id"]
FACTS = ["class_byte", "first_rec", "no_of_clicks", "first_us", "last_us", "min_ici_us"]


def parts(rows: DataFrame) -> DataFrame:
    """Clicks of whole minutes as one row per train; everything else row by row."""
    marker_bytes = [c for c in rows.columns if c.startswith("b")]
    single = F.when(F.col("what") != CLICK, F.col("rec_no")).alias("single")
    return rows.groupBy(*KEYS, single, "error").agg(
        F.min_by("class_byte", "rec_no").alias("class_byte"),
        F.min("rec_no").alias("first_rec"),
        F.count("*").alias("no_of_clicks"),
        F.min_by("time_us", "rec_no").alias("first_us"),
        F.max_by("time_us", "rec_no").alias("last_us"),
        F.min("ici_us").alias("min_ici_us"),
        *[F.max(c).alias(c) for c in marker_bytes],
    )


def _before(runs: Column) -> Column:
    """Markers of the earlier ranges, for each range of a file; ranges are numbered from 0 without gaps."""
    add = lambda n, run: n + run["markers"]
    return F.transform(runs, lambda _, i: F.aggregate(F.slice(runs, F.lit(1), i), F.lit(0).cast("long"), add))


def _total(runs: Column) -> Column:
    return F.aggregate(runs, F.lit(0).cast("long"), lambda n, run: n + run["markers"])


def file_facts(ends: DataFrame, parts: DataFrame, headers: DataFrame, raw: DataFrame | None = None, counts: DataFrame | None = None) -> DataFrame:
    """One row for each file: what its ranges, its header and its raw twin tell, and why it failed, if it did.

    ``ends`` (pod_file, last_rec) names the train files, ``raw`` the raw files beside them and ``counts`` their click
    counts. A file ends before its first end-of-file record. Files have as many entries in an array as ranges.
    """
    found = parts.filter(F.col("what").isin(RANGE, ENDED) | F.col("error").isNotNull()).select(
        "pod_file", "error",
        F.when(F.col("what") == RANGE, F.struct("split", "markers")).alias("run"),
        F.when(F.col("what") == ENDED, F.struct("split", F.col("single").alias("rec_no"), "markers")).alias("end"),
    )
    header = [c for c in headers.columns if c not in ("pod_file", "error")]
    tables = [ends.withColumn("is_train", F.lit(True)), found, headers]
    if raw is not None:
        known = counts.filter("total IS NOT NULL OR error IS NOT NULL")
        run = F.when(F.col("total").isNotNull(), F.struct("split", F.col("total").alias("markers")))
        tables.append(known.select("pod_file", F.col("error").alias("raw_error"), run.alias("raw_run")))
        tables.append(raw.select("pod_file", F.lit(True).alias("has_raw")))
    rows = tables[0]
    for table in tables[1:]:
        rows = rows.unionByName(table, allowMissingColumns=True)
    one = [c for c in ("is_train", "has_raw", "last_rec", *header) if c in rows.columns]
    errors = [c for c in ("error", "raw_error") if c in rows.columns]
    lists = {"run": "runs", "raw_run": "raw_runs"}
    facts = rows.groupBy("pod_file").agg(
        *(F.max(c).alias(c) for c in one),
        *(F.min(c).alias(c) for c in errors),
        F.min("end").alias("end"),
        *(F.sort_array(F.collect_list(c)).alias(name) for c, name in lists.items() if c in rows.columns),
    )
    before = _before(F.col("runs"))
    end = F.col("end")
    facts = facts.withColumn("before", before).withColumn(
        "n_markers", F.when(end.isNotNull(), F.get("before", end["split"].cast("int")) + end["markers"]).otherwise(_total(F.col("runs")))
    )
    if raw is not None:
        n_cp1 = F.when(F.col("raw_error").isNull(), F.nullif(_total(F.col("raw_runs")), F.lit(0).cast("long")))
        facts = facts.withColumn("raw_before", _before(F.col("raw_runs")))
        facts = facts.withColumn("has_tail", F.coalesce(n_cp1 > F.col("n_markers"), F.lit(False))).drop("raw_runs")
    return facts.drop("runs")


def good_files(facts: DataFrame) -> DataFrame:
    return facts.filter("is_train AND error IS NULL")


def in_minutes(parts: DataFrame, facts: DataFrame, closed: bool = False) -> DataFrame:
    """Parts of the files that did not fail, with ``minute``: markers of the file up to the row.

    With ``closed`` (C-POD) a file ends where ``facts`` says and its last record goes: it lies after the last marker
    or closes the tail minute.
    """
    rows = parts.filter(F.col("error").isNull() & ~F.col("what").isin(RANGE, ENDED))
    last = F.coalesce(F.col("end.rec_no") - 1, F.col("last_rec")).alias("_last")
    known = good_files(facts).select("pod_file", "before", F.col("end.split").alias("_split"), last)
    rows = rows.join(known, "pod_file").withColumn("minute", F.get("before", F.col("split").cast("int")) + F.col("markers"))
    if closed:
        within = F.col("_split").isNull() | (F.col("split") <= F.col("_split"))
        closes = F.col("what").isin(LOOSE_TRAIN, LOOSE_CLICK) & (F.col("single") == F.col("_last"))
        rows = rows.filter(within & ~closes)
    return rows.drop("before", "_split", "_last")


def marks(minutes: DataFrame) -> DataFrame:
    """Marker rows numbered from 1 in each file, with their bytes."""
    return minutes.filter(F.col("what") == MARK).withColumn("marker_no", F.col("minute"))


def _cpod_loose(minutes: DataFrame, shift: int) -> DataFrame:
    rows = minutes.filter((F.col("what") == LOOSE_TRAIN) & (F.col("minute") >= 1))
    return rows.select(
        "pod_file", (F.col("minute") + shift).alias("minute_no"), "train_id", "class_byte", F.col("first_us").alias("time_us"),
        F.col("single").alias("rec_no"),
    )


def _zipped(loose: DataFrame, detail: Column) -> DataFrame:
    """Pair the i-th train record of a minute with its i-th click record."""
    rows = loose.withColumn("detail", detail)
    placed = number_in_groups(rows, [*MINUTE, "detail"], "rec_no", "pos")
    pairs = placed.groupBy(*MINUTE, "pos").agg(
        F.max(F.when(F.col("detail"), F.col("rec_no"))).alias("rec_no"),
        F.max(F.when(F.col("detail"), F.col("train_id"))).alias("train_id"),
        F.max(F.when(F.col("detail"), F.col("class_byte"))).alias("class_byte"),
        F.max(F.when(~F.col("detail"), F.col("time_us"))).alias("time_us"),
    )
    return pairs.filter(F.col("rec_no").isNotNull())


def _fpod_loose(minutes: DataFrame, time: str, record: str) -> DataFrame:
    rows = minutes.filter(F.col("what").isin(LOOSE_TRAIN, LOOSE_CLICK) & (F.col("minute") >= 1))
    rows = rows.select(
        "what", "pod_file", F.col("minute").alias("minute_no"), "train_id", "class_byte", F.col(time).alias("time_us"), F.col(record).alias("rec_no")
    )
    return _zipped(rows, F.col("what") == LOOSE_TRAIN).drop("pos")


def train_facts(minutes: DataFrame, family: str) -> DataFrame:
    """One row per train. C-POD clicks after marker j belong to minute j + 1, F-POD clicks to minute j."""
    shift = 1 if family == "CP" else 0
    whole = minutes.filter(F.col("what") == CLICK)
    whole = whole.select("pod_file", (F.col("minute") + shift).alias("minute_no"), "train_id", *FACTS)
    loose = _cpod_loose(minutes, shift) if family == "CP" else _fpod_loose(minutes, "first_us", "single")
    return whole.unionByName(T.train_facts(loose))


def click_rows(minutes: DataFrame, family: str, values: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Clicks of whole minutes, with place and interval, and clicks of minutes that several ranges share."""
    shift = 1 if family == "CP" else 0
    named = [F.col(v).alias(k) for k, v in values.items()]
    keep = ["pod_file", (F.col("minute") + shift).alias("minute_no"), "train_id", "class_byte", "time_us", "rec_no", *named]
    whole = minutes.filter(F.col("what") == CLICK).select(*keep, "place", "ici_us")
    if family == "FP":
        return whole, _fpod_loose(minutes, "time_us", "rec_no")
    return whole, minutes.filter((F.col("what") == LOOSE_TRAIN) & (F.col("minute") >= 1)).select(*keep)


def click_arrays(whole: DataFrame, shared: DataFrame, values: list[str], segment_clicks: int = T.SEGMENT_CLICKS) -> DataFrame:
    """Clicks of each train as arrays; those of whole minutes are numbered already and are shuffled once."""
    keys = [*MINUTE, "train_id"]
    piece = F.expr(f"(place - 1) div {segment_clicks}").alias("segment_no")
    grouped = whole.groupBy(*keys, piece).agg(
        F.sort_array(F.collect_list(F.struct("place", *values, "ici_us"))).alias("_rows"),
        F.min_by("class_byte", "rec_no").alias("_class"),
        F.count("*").alias("_n"),
    )
    # One row a piece: the window sees a row for every 65,536 clicks of a train.
    over = W.partitionBy(*keys)
    grouped = grouped.withColumns({"no_of_clicks": F.sum("_n").over(over), "class_byte": F.min_by("_class", "segment_no").over(over)})
    first = grouped.select(
        *keys, "segment_no", "no_of_clicks", "class_byte", *[F.col(f"_rows.{v}").alias(v) for v in values],
        F.filter(F.col("_rows.ici_us"), lambda x: x.isNotNull()).alias("ici_us"),
    )
    return first.unionByName(T.click_arrays(shared, values, segment_clicks=segment_clicks))


def click_totals(counts: DataFrame, facts: DataFrame) -> DataFrame:
    """Click totals of each minute of raw files, from counts by range and marker."""
    known = facts.filter("has_raw AND raw_error IS NULL").select("pod_file", "raw_before")
    minute = F.get("raw_before", F.col("split").cast("int")) + F.col("markers")
    rows = counts.filter(F.col("error").isNull()).join(known, "pod_file").withColumn("minute_no", minute)
    return rows.filter("minute_no >= 1").groupBy(*MINUTE).agg(F.sum("n").alias("nall"))

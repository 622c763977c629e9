"""Queries over recorder clicks and record streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickloom.functions import amplitude as A, records as R
from clickloom.operators import detections as D, segment as G, trains as T
from clickloom.operators.noise import filtered_click_counts
from workload import fixtures as X
from workload.fixtures import with_views
from workload.registry import query

# Clicks of the input views lie further apart than real ones, so the buzz limit is wider here.
BUZZ_US = 2_000_000
TILT_MIN, TILT_MAX = 8, 100
START = "2024-01-01 00:00:00"

VIEWS = {
    "click_train": f"""
SELECT pod_file, minute_start, train_id, min(first_class) AS b37, count(*) AS no_of_clicks,
       min(first_t) AS first_us, min(last_t) AS last_us, min(ici) AS min_ici_us
FROM (SELECT *, first_value(b37) OVER w AS first_class, first_value(time_us) OVER w AS first_t,
             first_value(time_us) OVER (PARTITION BY pod_file, minute_start, train_id ORDER BY rec_no DESC) AS last_t,
             time_us - lag(time_us) OVER w AS ici
      FROM fx_clicks WINDOW w AS (PARTITION BY pod_file, minute_start, train_id ORDER BY rec_no)) c
GROUP BY pod_file, minute_start, train_id""",
    "click_minute": f"""
SELECT pod_file, minute_start, count(*) AS no_of_trains, CAST(sum(no_of_clicks) AS BIGINT) AS no_of_clicks,
       count(*) FILTER (sp = 0 AND q = 3) AS trainHi, count(*) FILTER (sp = 0 AND q = 2) AS trainMed,
       count(*) FILTER (sp = 0 AND q = 1) AS trainLow, count(*) FILTER (sp = 0 AND q = 0) AS trainAll,
       CAST(coalesce(sum(no_of_clicks) FILTER (sp = 0 AND q = 3), 0) AS BIGINT) AS clickHi,
       CAST(coalesce(sum(no_of_clicks) FILTER (sp = 0 AND q = 2), 0) AS BIGINT) AS clickMed,
       CAST(coalesce(sum(no_of_clicks) FILTER (sp = 0 AND q = 1), 0) AS BIGINT) AS clickLow,
       CAST(coalesce(sum(no_of_clicks) FILTER (sp = 0 AND q = 0), 0) AS BIGINT) AS clickAll,
       CAST(coalesce(sum(last_us - first_us) FILTER (sp = 0 AND q = 3), 0) AS BIGINT) AS usHi,
       CAST(coalesce(sum(last_us - first_us) FILTER (sp = 0 AND q = 2), 0) AS BIGINT) AS usMed,
       CAST(coalesce(sum(last_us - first_us) FILTER (sp = 0 AND q = 1), 0) AS BIGINT) AS usLow,
       CAST(count(*) FILTER (sp = 0 AND q = 3 AND min_ici_us < {BUZZ_US}) > 0 AS INT) AS buzzHi,
       CAST(count(*) FILTER (sp = 0 AND q = 2 AND min_ici_us < {BUZZ_US}) > 0 AS INT) AS buzzMed,
       CAST(count(*) FILTER (sp = 0 AND q = 1 AND min_ici_us < {BUZZ_US}) > 0 AS INT) AS buzzLow
FROM (SELECT *, (b37 & 240) >> 4 AS sp, b37 & 3 AS q FROM click_train) t
GROUP BY pod_file, minute_start""",
    "cp3": """
SELECT *, CASE WHEN rec_type = 254 THEN rec_no % 3 END AS b9 FROM fx_records r
WHERE NOT (pod_file LIKE 'FX1%' AND rec_type = 254
           AND rec_no = (SELECT max(rec_no) FROM fx_records m WHERE m.rec_type = 254 AND m.pod_file = r.pod_file))""",
    "cp3_seg": """
SELECT *, CAST(sum(CASE WHEN rec_type = 254 THEN 1 ELSE 0 END) OVER (PARTITION BY pod_file ORDER BY rec_no) AS BIGINT) AS seg_no,
       max(rec_no) OVER (PARTITION BY pod_file) AS last_rec
FROM cp3""",
    "cp1_seg": """
SELECT *, CAST(sum(CASE WHEN rec_type = 254 THEN 1 ELSE 0 END) OVER (PARTITION BY pod_file ORDER BY rec_no) AS BIGINT) AS seg_no
FROM fx_records""",
    "cp_files": """
SELECT pod_file, n3 AS n_markers, n1 AS n_cp1, n1 > n3 AS has_tail
FROM (SELECT pod_file, max(seg_no) AS n3 FROM cp3_seg GROUP BY pod_file) a
JOIN (SELECT pod_file, max(seg_no) AS n1 FROM cp1_seg GROUP BY pod_file) b USING (pod_file)""",
    "cp_minutes": f"""
SELECT f.pod_file, f.n_markers, f.has_tail, k.minute_no, m.b9 AS raw_clicks, m.b5 AS tilt,
       coalesce(m.b4 / 5.0::DOUBLE, 0) AS temperature, coalesce(degrees(acos(1 - m.b5 / 128.0::DOUBLE)), 0) AS angle,
       TIMESTAMP '{START}' + to_minutes(k.minute_no - 1) AS minute_start
FROM cp_files f
JOIN (SELECT pod_file, seg_no + 1 AS minute_no FROM cp3_seg WHERE rec_type = 254
      UNION ALL SELECT pod_file, 1 FROM cp_files) k ON k.pod_file = f.pod_file AND k.minute_no <= f.n_markers + CAST(f.has_tail AS INT)
LEFT JOIN cp3_seg m ON m.pod_file = f.pod_file AND m.rec_type = 254 AND m.seg_no = k.minute_no - 1""",
    "cp_nall": """
SELECT pod_file, seg_no AS minute_no, count(*) - 1 AS nall FROM cp1_seg WHERE seg_no >= 1 GROUP BY pod_file, seg_no""",
    "cp_clicks": """
SELECT s.pod_file, s.seg_no + 1 AS minute_no, s.rec_type AS train_id, s.rec_no, s.b37, s.time_us
FROM cp3_seg s JOIN cp_files f USING (pod_file)
WHERE s.rec_type < 254 AND s.seg_no >= 1 AND s.rec_no < s.last_rec AND s.seg_no + 1 <= f.n_markers + CAST(f.has_tail AS INT)""",
    "cp_train": f"""
SELECT pod_file, minute_no, train_id, (b37 & 240) >> 4 AS sp, b37 & 3 AS q, no_of_clicks, last_us - first_us AS us, ici
FROM (SELECT pod_file, minute_no, train_id, arg_min(b37, rec_no) AS b37, count(*) AS no_of_clicks,
             arg_min(time_us, rec_no) AS first_us, arg_max(time_us, rec_no) AS last_us, min(ici) AS ici
      FROM (SELECT *, time_us - lag(time_us) OVER (PARTITION BY pod_file, minute_no, train_id ORDER BY rec_no) AS ici FROM cp_clicks) c
      GROUP BY pod_file, minute_no, train_id) t""",
    "fp_seg": """
SELECT *, CAST(sum(CASE WHEN rec_type = 254 THEN 1 ELSE 0 END) OVER (PARTITION BY pod_file ORDER BY rec_no) AS BIGINT) AS seg_no
FROM fx_fp_records""",
    "fp_minutes": f"""
SELECT pod_file, seg_no AS minute_no, CAST(b8 AS DOUBLE) AS temperature, round(degrees(acos(1 - b4 / 128.0::DOUBLE))) AS angle,
       CAST(b9 * 256 + b10 AS BIGINT) AS nall, TIMESTAMP '{START}' + to_minutes(seg_no - 1) AS minute_start
FROM fp_seg WHERE rec_type = 254""",
    "fp_zip": """
SELECT t.pod_file, t.seg_no AS minute_no, t.pos, t.rec_no, t.b16 AS train_id, t.b15 AS class_byte, c.time_us
FROM (SELECT *, row_number() OVER (PARTITION BY pod_file, seg_no ORDER BY rec_no) AS pos FROM fp_seg WHERE rec_type = 249) t
LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY pod_file, seg_no ORDER BY rec_no) AS pos FROM fp_seg WHERE rec_type <= 183) c
  ON c.pod_file = t.pod_file AND c.seg_no = t.seg_no AND c.pos = t.pos""",
    "fp_train": """
SELECT pod_file, minute_no, train_id, (b15 & 12) >> 2 AS sp, b15 & 3 AS q, CAST(b15 & 64 = 64 AS INT) AS good,
       CAST(b15 & 128 = 128 AS INT) AS rate, no_of_clicks, last_us - first_us AS us, ici
FROM (SELECT pod_file, minute_no, train_id, arg_min(class_byte, rec_no) AS b15, count(*) AS no_of_clicks,
             arg_min(time_us, rec_no) AS first_us, arg_max(time_us, rec_no) AS last_us, min(ici) AS ici
      FROM (SELECT *, time_us - lag(time_us) OVER (PARTITION BY pod_file, minute_no, train_id ORDER BY rec_no) AS ici FROM fp_zip) c
      GROUP BY pod_file, minute_no, train_id) t""",
}
_NEEDS = {
    "click_train": (["fx_clicks"], []),
    "click_minute": (["fx_clicks"], ["click_train"]),
    "cp3": (["fx_records"], []),
    "cp3_seg": (["fx_records"], ["cp3"]),
    "cp1_seg": (["fx_records"], []),
    "cp_files": (["fx_records"], ["cp3", "cp3_seg", "cp1_seg"]),
    "cp_minutes": (["fx_records"], ["cp3", "cp3_seg", "cp1_seg", "cp_files"]),
    "cp_nall": (["fx_records"], ["cp1_seg"]),
    "cp_clicks": (["fx_records"], ["cp3", "cp3_seg", "cp1_seg", "cp_files"]),
    "cp_train": (["fx_records"], ["cp3", "cp3_seg", "cp1_seg", "cp_files", "cp_clicks"]),
    "fp_seg": (["fx_fp_records"], []),
    "fp_minutes": (["fx_fp_records"], ["fp_seg"]),
    "fp_zip": (["fx_fp_records"], ["fp_seg"]),
    "fp_train": (["fx_fp_records"], ["fp_seg", "fp_zip"]),
}


def views(body: str, *names: str) -> str:
    base, own = [], []
    for name in names:
        needs = _NEEDS.get(name, ([name], []))
        base += [b for b in needs[0] if b not in base]
        own += [o for o in [*needs[1], *([name] if name in VIEWS else [])] if o not in own]
    return with_views(body, *base, extra={o: VIEWS[o] for o in VIEWS if o in own})


def quality_rows_sql(minutes: str, trains: str, good: str = "TRUE", buzz: int = BUZZ_US) -> str:
    """Output rows from minute and train views."""
    return f"""
SELECT m.minute_start AS DETECTION_DATE_TIME, round(m.temperature) AS TEMPERATURE, round(m.angle) AS ANGLE,
       m.nall AS NUMBER_CLICKS_TOTAL, m.pod_file AS filename, q.QUALITY,
       CAST(coalesce(sum(t.no_of_clicks) FILTER ({good}), 0) AS BIGINT) AS NUMBER_CLICKS_FILTERED,
       CAST(coalesce(sum(t.no_of_clicks) FILTER ({good}), 0) <> 0 AS INT) AS DPM,
       CAST(round(coalesce(sum(t.us), 0) * 0.001::DOUBLE) AS BIGINT) AS MILLISECONDS,
       CAST(coalesce(min(t.ici) < {buzz}, FALSE) AS INT) AS BPM,
       CAST(coalesce(m.nall > 4096, FALSE) AS INT) AS TIME_LOST_PERCENTAGE, 'NBHF' AS SPECIES,
       CAST(coalesce(m.nall > 0 AND round(m.angle) < 80, FALSE) AS INT) AS RECORDED
FROM {minutes} m CROSS JOIN (SELECT 'Hi' AS QUALITY, 3 AS code UNION ALL SELECT 'Mod', 2 UNION ALL SELECT 'Lo', 1) q
LEFT JOIN {trains} t ON t.pod_file = m.pod_file AND t.minute_no = m.minute_no AND t.sp = 0 AND t.q = q.code
GROUP BY m.minute_start, m.temperature, m.angle, m.nall, m.pod_file, m.minute_no, q.QUALITY"""


# ---- clicks already cut into minutes


def fx_clicks(spark: SparkSession, sf: str) -> DataFrame:
    return X.clicks(spark, sf).withColumn("class_byte", F.col("b37"))


def click_trains(spark: SparkSession, sf: str) -> DataFrame:
    return T.with_class(T.train_facts(fx_clicks(spark, sf), "minute_start"))


def click_minutes(spark: SparkSession, sf: str) -> DataFrame:
    return T.minute_counts(click_trains(spark, sf), "minute_start", buzz_us=BUZZ_US)


KEY = ["pod_file", "minute_start"]


@query(
    "g1_click_trains",
    views(
        "SELECT pod_file, minute_start, train_id, b37 & 3 AS quality_class, (b37 & 240) >> 4 AS species_class, "
        "no_of_clicks, first_us, last_us, min_ici_us FROM click_train",
        "click_train",
    ),
    gaps=("min_ici_us",),
)
def g1(spark, sf):
    return click_trains(spark, sf).select(
        *KEY, "train_id", "quality_class", "species_class", "no_of_clicks", "first_us", "last_us", "min_ici_us"
    )


@query(
    "r4_train_click_arrays",
    views(
        f"""SELECT pod_file, minute_start, train_id, (pos - 1) // {T.SEGMENT_CLICKS} AS segment_no,
       string_agg(CAST(time_us AS VARCHAR), ',' ORDER BY pos) AS times, string_agg(CAST(nix AS VARCHAR), ',' ORDER BY pos) AS nix,
       coalesce(string_agg(CAST(ici AS VARCHAR), ',' ORDER BY pos), '') AS icis
FROM (SELECT *, row_number() OVER w AS pos, time_us - lag(time_us) OVER w AS ici FROM fx_clicks
      WINDOW w AS (PARTITION BY pod_file, minute_start, train_id ORDER BY rec_no)) c
GROUP BY ALL""",
        "fx_clicks",
    ),
)
def r4(spark, sf):
    rows = T.click_arrays(fx_clicks(spark, sf), ["time_us", "nix"], "minute_start")
    return rows.select(
        *KEY, "train_id", "segment_no",
        F.array_join("time_us", ",").alias("times"),
        F.array_join("nix", ",").alias("nix"),
        F.array_join("ici_us", ",").alias("icis"),
    )


@query("g3_minute_totals", views("SELECT pod_file, minute_start, no_of_trains, no_of_clicks FROM click_minute", "click_minute"))
def g3(spark, sf):
    return click_minutes(spark, sf).select(*KEY, "no_of_trains", "no_of_clicks")


@query(
    "g4_train_counts_by_quality",
    views("SELECT pod_file, minute_start, trainHi, trainMed, trainLow, trainAll FROM click_minute", "click_minute"),
)
def g4(spark, sf):
    return click_minutes(spark, sf).select(*KEY, "trainHi", "trainMed", "trainLow", "trainAll")


@query(
    "g5_click_counts_by_quality",
    views("SELECT pod_file, minute_start, clickHi, clickMed, clickLow, clickAll FROM click_minute", "click_minute"),
)
def g5(spark, sf):
    return click_minutes(spark, sf).select(*KEY, "clickHi", "clickMed", "clickLow", "clickAll")


@query(
    "g6_train_time_by_quality",
    views(
        "SELECT pod_file, minute_start, CAST(round(usHi * 0.001::DOUBLE) AS BIGINT) AS msHi, "
        "CAST(round(usMed * 0.001::DOUBLE) AS BIGINT) AS msMed, CAST(round(usLow * 0.001::DOUBLE) AS BIGINT) AS msLow FROM click_minute",
        "click_minute",
    ),
)
def g6(spark, sf):
    ms = [D.milliseconds(F.col(f"us{q}")).alias(f"ms{q}") for q in ("Hi", "Med", "Low")]
    return click_minutes(spark, sf).select(*KEY, *ms)


@query(
    "g7_buzz_flag",
    views("SELECT pod_file, minute_start, buzzHi, buzzMed, buzzLow FROM click_minute", "click_minute"),
)
def g7(spark, sf):
    return click_minutes(spark, sf).select(*KEY, "buzzHi", "buzzMed", "buzzLow")


@query(
    "w9_inter_click_interval",
    views(
        "SELECT pod_file, minute_start, train_id, rec_no, "
        "time_us - lag(time_us) OVER (PARTITION BY pod_file, minute_start, train_id ORDER BY rec_no) AS ici_us FROM fx_clicks",
        "fx_clicks",
    ),
    gaps=("ici_us",),
)
def w9(spark, sf):
    return T.with_interval(fx_clicks(spark, sf), "minute_start").select(*KEY, "train_id", "rec_no", "ici_us")


@query(
    "u6_explode_trains",
    views("SELECT pod_file, minute_start, train_id, no_of_clicks, last_us - first_us AS span_us FROM click_train", "click_train"),
)
def u6(spark, sf):
    """Nest the trains of each minute (at most 254 by the record format) and explode them again."""
    nested = click_trains(spark, sf).groupBy(*KEY).agg(
        F.collect_list(F.struct("train_id", "no_of_clicks", (F.col("last_us") - F.col("first_us")).alias("span_us"))).alias("train")
    )
    return nested.select(*KEY, F.inline("train"))


U5_SQL = """
SELECT pod_file, minute_start, 'Hi' AS QUALITY, clickHi AS NUMBER_CLICKS_FILTERED, CAST(clickHi <> 0 AS INT) AS DPM FROM click_minute
UNION ALL SELECT pod_file, minute_start, 'Mod', clickMed, CAST(clickMed <> 0 AS INT) FROM click_minute
UNION ALL SELECT pod_file, minute_start, 'Lo', clickLow, CAST(clickLow <> 0 AS INT) FROM click_minute"""


@query("u5_unpivot_quality", views(U5_SQL, "click_minute"))
def u5(spark, sf):
    return D.by_quality(click_minutes(spark, sf)).select(*KEY, "QUALITY", "NUMBER_CLICKS_FILTERED", "DPM")


@query(
    "f6_cpod_class_byte",
    views(
        """SELECT pod_file, rec_no, b37 & 3 AS quality_class, list_extract(['Doubtful','Low','Medium','High'], (b37 & 3) + 1) AS quality,
       (b37 & 240) >> 4 AS species_class,
       coalesce(list_extract(['NBHF','Dolphin','Unclass.','Sonar','HEL1'], ((b37 & 240) >> 4) + 1), 'Unknown') AS species,
       (b37 & 4) >> 2 AS rate_good, (b37 & 8) >> 3 AS species_good
FROM (SELECT pod_file, rec_no, (b37 + nix * 16) % 256 AS b37 FROM fx_clicks) c""",
        "fx_clicks",
    ),
)
def f6(spark, sf):
    b = (F.col("b37") + F.col("nix") * 16) % 256
    return X.clicks(spark, sf).select("pod_file", "rec_no", *[v.alias(k) for k, v in R.cpod_class(b).items()])


@query(
    "f7_fpod_class_byte",
    views(
        """SELECT pod_file, rec_no, b & 3 AS quality_class, list_extract(['Doubtful','Low','Medium','High'], (b & 3) + 1) AS quality,
       (b & 12) >> 2 AS species_class, list_extract(['NBHF','Dolphin','Unclass.','Sonar','possibleSonar'], ((b & 12) >> 2) + 1) AS species,
       CAST(b & 128 = 128 AS INT) AS rate_good, CAST(b & 64 = 64 AS INT) AS species_good
FROM (SELECT pod_file, rec_no, nix AS b FROM fx_clicks) c""",
        "fx_clicks",
    ),
)
def f7(spark, sf):
    return X.clicks(spark, sf).select("pod_file", "rec_no", *[v.alias(k) for k, v in R.fpod_class(F.col("nix")).items()])


@query(
    "f8_click_time",
    views(
        "SELECT pod_file, rec_no, 5 * ((CAST(rec_no % 256 AS BIGINT) * 256 + nix) * 256 + b37) AS time_us FROM fx_clicks",
        "fx_clicks",
    ),
)
def f8(spark, sf):
    return X.clicks(spark, sf).select(
        "pod_file", "rec_no", R.click_time_us(F.col("rec_no") % 256, F.col("nix"), F.col("b37")).alias("time_us")
    )


@query(
    "p10_round_and_label",
    views(
        "SELECT pod_file, rec_no, round((b37 - 20) / 2.0::DOUBLE) + 0 AS ANGLE, round((nix - 128) / 4.0::DOUBLE) + 0 AS TEMPERATURE, 'NBHF' AS SPECIES FROM fx_clicks",
        "fx_clicks",
    ),
)
def p10(spark, sf):
    return X.clicks(spark, sf).select(
        "pod_file", "rec_no",
        F.round((F.col("b37") - 20) / 2.0).alias("ANGLE"),
        F.round((F.col("nix") - 128) / 4.0).alias("TEMPERATURE"),
        F.lit(D.SPECIES).alias("SPECIES"),
    )


FLAG_NALL = "(nix * 40)"


@query(
    "p13_lost_minute_flag",
    views(f"SELECT pod_file, rec_no, CAST({FLAG_NALL} > 4096 AS INT) AS TIME_LOST_PERCENTAGE FROM fx_clicks", "fx_clicks"),
)
def p13(spark, sf):
    return X.clicks(spark, sf).select(
        "pod_file", "rec_no", D.time_lost(F.col("nix") * 40).alias("TIME_LOST_PERCENTAGE")
    )


@query(
    "p14_recorded_flag",
    views(
        "SELECT pod_file, rec_no, CAST(nix > 0 AND round(b37 * 2.5::DOUBLE) < 80 AS INT) AS RECORDED FROM fx_clicks", "fx_clicks"
    ),
)
def p14(spark, sf):
    return X.clicks(spark, sf).select(
        "pod_file", "rec_no", D.recorded(F.col("nix"), F.round(F.col("b37") * 2.5)).alias("RECORDED")
    )


# ---- C-POD record streams


def cp3_bounds(spark: SparkSession, sf: str) -> DataFrame:
    """Markers of the CP3 stream: about one row per minute."""
    return G.boundaries(X.cp3(spark, sf)).drop("b37", "time_us")


def cp1_bounds(spark: SparkSession, sf: str) -> DataFrame:
    return G.boundaries(X.records(spark, sf)).drop("b37", "time_us")


def ends(records: DataFrame) -> DataFrame:
    """Last record number of each file; a file source knows it from the file length."""
    return records.groupBy("pod_file").agg(F.max("rec_no").alias("last_rec"))


def cp3_segments(spark: SparkSession, sf: str) -> DataFrame:
    rows = X.cp3(spark, sf)
    return G.segment(rows, offsets=G.run_offsets(cp3_bounds(spark, sf), ends(rows)), stop_at_end=True)


def cp3_marks(spark: SparkSession, sf: str) -> DataFrame:
    return G.markers(G.segment(cp3_bounds(spark, sf), stop_at_end=True))


def cp_files(spark: SparkSession, sf: str) -> DataFrame:
    return G.tail_files(cp3_marks(spark, sf), G.markers(G.segment(cp1_bounds(spark, sf))))


def cp_minute_rows(spark: SparkSession, sf: str) -> DataFrame:
    files = cp_files(spark, sf).drop("n_cp1").withColumn("start_time", F.lit(START).cast("timestamp_ntz"))
    return G.with_clock(G.cpod_minute_rows(cp3_marks(spark, sf), files))


def cp_nall(spark: SparkSession, sf: str) -> DataFrame:
    return G.cp1_click_totals(cp1_bounds(spark, sf), ends(X.records(spark, sf)))


def cp_trains(spark: SparkSession, sf: str) -> DataFrame:
    clicks = G.cpod_clicks(cp3_segments(spark, sf)).withColumnRenamed("b37", "class_byte")
    return T.with_class(T.train_facts(clicks))


@query(
    "w1_segment_cpod",
    views("SELECT pod_file, rec_no, rec_type, minute_no FROM (SELECT pod_file, rec_no, train_id AS rec_type, minute_no FROM cp_clicks) c", "cp_clicks"),
)
def w1(spark, sf):
    rows = cp_minute_rows(spark, sf).select(*G.MINUTE)
    clicks = G.cpod_clicks(cp3_segments(spark, sf)).join(rows, G.MINUTE, "left_semi")
    return clicks.select("pod_file", "rec_no", F.col("train_id").alias("rec_type"), "minute_no")


@query("w3_tail_minute", views("SELECT pod_file, n_markers, n_cp1, CAST(has_tail AS INT) AS has_tail FROM cp_files", "cp_files"))
def w3(spark, sf):
    return cp_files(spark, sf).withColumn("has_tail", F.col("has_tail").cast("int"))


@query(
    "w4_shifted_minute_attributes",
    views("SELECT pod_file, minute_no, round(temperature, 6) AS temperature, round(angle, 6) AS angle FROM cp_minutes", "cp_minutes"),
)
def w4(spark, sf):
    return cp_minute_rows(spark, sf).select(
        *G.MINUTE, F.round("temperature", 6).alias("temperature"), F.round("angle", 6).alias("angle")
    )


@query("w6_cp1_click_totals", views("SELECT pod_file, minute_no, nall FROM cp_nall", "cp_nall"))
def w6(spark, sf):
    return cp_nall(spark, sf)


@query("w8_minute_clock", views("SELECT pod_file, minute_no, minute_start FROM cp_minutes", "cp_minutes"))
def w8(spark, sf):
    return cp_minute_rows(spark, sf).select(*G.MINUTE, "minute_start")


@query(
    "j5_minutes_with_nall",
    views("SELECT pod_file, minute_no, nall FROM cp_minutes LEFT JOIN cp_nall USING (pod_file, minute_no)", "cp_minutes", "cp_nall"),
)
def j5(spark, sf):
    return G.with_nall(cp_minute_rows(spark, sf), cp_nall(spark, sf)).select(*G.MINUTE, "nall")


@query(
    "p15_cpod_minute_on",
    views(
        f"""SELECT pod_file, minute_no, CASE WHEN minute_no = 1 THEN 0 WHEN raw_clicks > 0 THEN 1
       WHEN tilt > {TILT_MAX} OR tilt < {TILT_MIN} THEN 0 ELSE 1 END AS minute_on FROM cp_minutes""",
        "cp_minutes",
    ),
)
def p15(spark, sf):
    rows = cp_minute_rows(spark, sf).withColumns({"tilt_min": F.lit(TILT_MIN), "tilt_max": F.lit(TILT_MAX)})
    return G.with_minute_on(rows).select(*G.MINUTE, "minute_on")


CP_ROWS_SQL = quality_rows_sql("(SELECT * FROM cp_minutes LEFT JOIN cp_nall USING (pod_file, minute_no))", "cp_train")


@query("c1_cpod_detection_rows", views(CP_ROWS_SQL, "cp_minutes", "cp_nall", "cp_train"))
def c1_rows(spark, sf):
    """From typed records to the output rows of all C-POD files."""
    rows = G.with_nall(cp_minute_rows(spark, sf), cp_nall(spark, sf))
    counts = T.minute_counts(cp_trains(spark, sf), buzz_us=BUZZ_US)
    return D.output_rows(D.fill_empty_minutes(rows, counts))


# ---- F-POD record streams


def fp_seg(spark: SparkSession, sf: str) -> DataFrame:
    return G.segment(X.fp_records(spark, sf), G.fpod_counters())


def fp_minute_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = G.fpod_minute_rows(G.markers(fp_seg(spark, sf)))
    return G.with_clock(rows.withColumn("start_time", F.lit(START).cast("timestamp_ntz")))


def fp_trains(spark: SparkSession, sf: str) -> DataFrame:
    zipped = G.zip_by_position(fp_seg(spark, sf))
    return T.with_class(T.train_facts(zipped), "FP")


@query("w2_segment_fpod", views("SELECT pod_file, rec_no, rec_type, seg_no AS minute_no FROM fp_seg WHERE seg_no >= 1 AND rec_type <> 254", "fp_seg"))
def w2(spark, sf):
    rows = G.segment(X.fp_records(spark, sf)).filter("seg_no >= 1 AND rec_type <> 254")
    return rows.select("pod_file", "rec_no", "rec_type", F.col("seg_no").alias("minute_no"))


@query("w5_fpod_minute_attributes", views("SELECT pod_file, minute_no, temperature, angle FROM fp_minutes", "fp_minutes"))
def w5(spark, sf):
    return fp_minute_rows(spark, sf).select(*G.MINUTE, "temperature", "angle")


@query("w7_fpod_nall", views("SELECT pod_file, minute_no, nall FROM fp_minutes", "fp_minutes"))
def w7(spark, sf):
    return fp_minute_rows(spark, sf).select(*G.MINUTE, "nall")


@query("p16_fpod_minute_on", views("SELECT pod_file, minute_no, CAST(nall <> 0 AS INT) AS minute_on FROM fp_minutes", "fp_minutes"))
def p16(spark, sf):
    return fp_minute_rows(spark, sf).select(*G.MINUTE, "minute_on")


@query("j6_zip_by_position", views("SELECT pod_file, minute_no, pos, train_id, class_byte, time_us FROM fp_zip WHERE time_us IS NOT NULL", "fp_zip"))
def j6(spark, sf):
    zipped = G.zip_by_position(fp_seg(spark, sf), need_click=True)
    return zipped.select(*G.MINUTE, "pos", "train_id", "class_byte", "time_us")


@query(
    "g2_fpod_trains",
    views(
        "SELECT pod_file, minute_no, train_id, sp AS species_class, q AS quality_class, good AS species_good, rate AS rate_good, no_of_clicks, us AS span_us, ici AS min_ici_us FROM fp_train",
        "fp_train",
    ),
    gaps=("min_ici_us",),
)
def g2(spark, sf):
    return fp_trains(spark, sf).select(
        *G.MINUTE, "train_id", "species_class", "quality_class", "species_good", "rate_good", "no_of_clicks",
        (F.col("last_us") - F.col("first_us")).alias("span_us"), "min_ici_us",
    )


@query("c2_fpod_detection_rows", views(quality_rows_sql("fp_minutes", "fp_train", "t.good = 1"), "fp_minutes", "fp_train"))
def c2_rows(spark, sf):
    counts = T.minute_counts(fp_trains(spark, sf), need_species_good=True, buzz_us=BUZZ_US)
    return D.output_rows(D.fill_empty_minutes(fp_minute_rows(spark, sf), counts))


@query(
    "u1_append_detections",
    views(
        f"SELECT * FROM ({CP_ROWS_SQL}) a UNION ALL BY NAME SELECT * FROM ({quality_rows_sql('fp_minutes', 'fp_train', 't.good = 1')}) b",
        "cp_minutes", "cp_nall", "cp_train", "fp_minutes", "fp_train",
    ),
)
def u1(spark, sf):
    return c1_rows(spark, sf).unionByName(c2_rows(spark, sf))


# ---- amplitude and frequency of F-POD clicks


def fp_clicks_sql(ipi: str = "rec_no % 300", extended: str = "rec_no % 2 = 0") -> str:
    return f"""
SELECT pod_file, rec_no, nix AS raw_peak, CAST({ipi} AS INT) + 1 AS ipi, CAST(rec_no % 24 AS INT) AS cycles,
       CAST(time_us % 256 AS INT) AS b14, CAST(rec_no % 256 AS INT) AS b15, {extended} AS has_extended_amps
FROM fx_clicks"""


def real_peak_sql(clicks: str) -> str:
    return f"""
SELECT pod_file, rec_no, CAST(CASE WHEN NOT has_extended_amps THEN greatest(raw_peak, 2)
    WHEN raw_peak > 222 AND ipi BETWEEN 10 AND 256 THEN
      least(50 * ipi, greatest(384, CASE WHEN raw_peak = 255 THEN 50 * ipi ELSE
        least(50 * ipi, round(power(4000.0::DOUBLE / ipi, -0.75) * power(10.0::DOUBLE, 5.24 * power(rise::DOUBLE, -0.11)))) END))
    WHEN greatest(raw_peak, 2) < 128 THEN greatest(raw_peak, 2) * 2 ELSE raw_peak + 128 END AS INT) AS real_peak
FROM (SELECT *, CASE WHEN raw_peak < 232 THEN 32 + (231 - raw_peak) * 4 WHEN raw_peak < 240 THEN 16 + (239 - raw_peak) * 2
                     ELSE 255 - raw_peak END AS rise FROM ({clicks}) c) r"""


def amplitude_clicks(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("rec_no")
    return X.clicks(spark, sf).select(
        "pod_file", "rec_no", F.col("nix").alias("raw_peak"),
        ((n % 300).cast("int") + 1).alias("ipi"),
        (n % 24).cast("int").alias("cycles"),
        (F.col("time_us") % 256).cast("int").alias("b14"),
        (n % 256).cast("int").alias("b15"),
        (n % 2 == 0).alias("has_extended_amps"),
    )


@query("f12_real_amplitude", views(real_peak_sql(fp_clicks_sql()), "fx_clicks"))
def f12(spark, sf):
    return A.with_real_amplitude(amplitude_clicks(spark, sf)).select("pod_file", "rec_no", "real_peak")


@query(
    "f13_click_frequency",
    views(
        f"""SELECT pod_file, rec_no, CAST(pk AS INT) AS khz, CAST(CASE WHEN abs(dur - pk) > 30 THEN pk ELSE dur END AS INT) AS khz_from_duration
FROM (SELECT *, CASE WHEN cycles >= 5 AND cycles < 16 AND d >= 100 THEN round(4000.0::DOUBLE * (cycles - 3) / d)
                     WHEN cycles >= 16 AND d >= 100 THEN round(60000.0::DOUBLE / d) ELSE pk END AS dur
      FROM (SELECT *, round(4000.0::DOUBLE / ipi) AS pk, ((b14 & 240) << 4) | b15 AS d FROM ({fp_clicks_sql()}) c) a) b""",
        "fx_clicks",
    ),
)
def f13(spark, sf):
    duration = A.click_duration(F.col("b14"), F.col("b15"))
    return amplitude_clicks(spark, sf).select(
        "pod_file", "rec_no", A.peak_khz(F.col("ipi")).alias("khz"),
        A.duration_khz(F.col("ipi"), F.col("cycles"), duration).alias("khz_from_duration"),
    )


# Frequency by interval, and by duration where that is near it.
KHZ = "round(4000.0::DOUBLE / c.ipi)"
KHZ_BY_DURATION = """(SELECT CASE WHEN abs(dur - pk) > 30 THEN pk ELSE dur END FROM (SELECT pk,
    CASE WHEN c.cycles >= 5 AND c.cycles < 16 AND d >= 100 THEN round(4000.0::DOUBLE * (c.cycles - 3) / d)
         WHEN c.cycles >= 16 AND d >= 100 THEN round(60000.0::DOUBLE / d) ELSE pk END AS dur
    FROM (SELECT round(4000.0::DOUBLE / c.ipi) AS pk, ((c.b14 & 240) << 4) | c.b15 AS d) p) q)"""


def c10_sql(khz: str = KHZ, **columns: str) -> str:
    clicks = fp_clicks_sql(**columns)
    return f"""SELECT m.pod_file, m.minute_no, count(k.rec_no) AS nall
FROM (SELECT pod_file, seg_no AS minute_no FROM cp1_seg WHERE rec_type = 254) m
LEFT JOIN (SELECT s.pod_file, s.seg_no, s.rec_no FROM cp1_seg s
           JOIN (SELECT row_number() OVER (PARTITION BY pod_file ORDER BY rec_no) AS click_no, pod_file, rec_no FROM cp1_seg WHERE rec_type < 254) n
             ON n.pod_file = s.pod_file AND n.rec_no = s.rec_no
           JOIN ({real_peak_sql(clicks)}) a ON a.pod_file = n.pod_file AND a.rec_no = n.click_no
           JOIN ({clicks}) c ON c.pod_file = n.pod_file AND c.rec_no = n.click_no
           WHERE a.real_peak > 11 AND {khz} BETWEEN 21 AND 221) k
  ON k.pod_file = m.pod_file AND k.seg_no = m.minute_no
GROUP BY m.pod_file, m.minute_no"""


@query("c10_filtered_click_counts", views(c10_sql(), "fx_clicks", "cp1_seg"))
def c10(spark, sf):
    """Markers and clicks as an FP1 stream whose click bytes hold the amplitude view."""
    hours = X.hours_of(spark, sf)
    marks = X.records(spark, sf).filter("rec_type = 254").select("pod_file", "rec_no", "rec_type")
    keyed = X.clicks(spark, sf).select("pod_file", "rec_no", "minute_start").join(
        hours.select("pod_file", "minute_start", "m"), ["pod_file", "minute_start"]
    )
    inner = amplitude_clicks(spark, sf).join(keyed, ["pod_file", "rec_no"]).select(
        "pod_file",
        (F.col("rec_no") + F.col("m")).alias("rec_no"),
        F.lit(100).alias("rec_type"),
        F.col("cycles").alias("b4"),
        (F.col("ipi") - 1).alias("b7"),
        F.col("raw_peak").alias("b11"),
        "b14", "b15", "has_extended_amps",
    )
    return filtered_click_counts(marks.unionByName(inner, allowMissingColumns=True))

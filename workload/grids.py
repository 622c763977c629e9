"""Queries on time grids and on the comparison with a vendor export."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickloom.functions import records as R
from clickloom.operators import reconcile as C, timegrid as G
from workload import fixtures as X
from workload.fixtures import with_views
from workload.registry import query

KEYS = ["pod_file"]
CLICKS = """
SELECT pod_file, ts AS time, b37 & 3 AS quality, nix AS duration,
       list_extract(['NBHF','Dolphin','Unclass.','Sonar','HEL1'], ((b37 & 240) >> 4) + 1) AS species FROM fx_clicks"""
SPANS = "SELECT pod_file, min(time) AS start_at, max(time) AS end_at FROM k GROUP BY pod_file"
GRID = """
SELECT s.pod_file, unnest(generate_series(date_trunc('minute', s.start_at), s.end_at, INTERVAL 1 MINUTE)) AS time FROM spans s"""
SPECIES_GRID = "SELECT g.pod_file, g.time, p.species FROM grid g JOIN (SELECT DISTINCT pod_file, species FROM k) p USING (pod_file)"
PER_MINUTE = """
SELECT pod_file, date_trunc('minute', time) AS time, species, count(*) AS nclicks, CAST(sum(duration) AS BIGINT) AS duration
FROM k WHERE quality IN (2, 3) GROUP BY ALL"""
FILLED = """
SELECT pod_file, time, species, coalesce(nclicks, 0) AS nclicks, coalesce(duration, 0) AS duration
FROM species_grid FULL JOIN per_minute USING (pod_file, time, species)"""
VIEWS = {
    "k": CLICKS, "spans": SPANS, "grid": GRID, "species_grid": SPECIES_GRID, "per_minute": PER_MINUTE, "filled": FILLED,
}


def views(body: str) -> str:
    return with_views(body, "fx_clicks", extra=VIEWS)


def events(spark, sf):
    """Clicks with real times; the duration is a whole number, so sums do not depend on their order."""
    fields = R.cpod_class(F.col("b37"))
    return X.clicks(spark, sf).select(
        "pod_file", F.col("ts").alias("time"), fields["quality_class"].alias("quality"), F.col("nix").alias("duration"),
        fields["species"].alias("species"),
    )


def spans(spark, sf):
    return events(spark, sf).groupBy(*KEYS).agg(F.min("time").alias("start"), F.max("time").alias("end"))


@query("p11_quality_filter", views("SELECT pod_file, time, quality FROM k WHERE quality IN (2, 3)"))
def p11(spark, sf):
    return G.high_and_moderate(events(spark, sf)).select("pod_file", "time", "quality")


@query("p12_species_filter", views("SELECT pod_file, time, species FROM k WHERE species = 'NBHF'"))
def p12(spark, sf):
    return G.only_species(events(spark, sf)).select("pod_file", "time", "species")


@query("f15_scale_and_bin", views("SELECT pod_file, time, duration * 1000 AS milliseconds, date_trunc('second', time) AS bin FROM k"))
def f15(spark, sf):
    return events(spark, sf).select(
        "pod_file", "time", (F.col("duration") * 1000).alias("milliseconds"), G.truncate("second", F.col("time")).alias("bin")
    )


@query("g12_clicks_per_species", views("SELECT * FROM per_minute"))
def g12(spark, sf):
    return G.clicks_per_species(G.high_and_moderate(events(spark, sf)), "minute", KEYS)


@query(
    "g14_clicks_per_bin",
    views("SELECT pod_file, date_trunc('second', time) AS time, count(*) AS nclicks FROM k GROUP BY ALL"),
)
def g14(spark, sf):
    return G.clicks_per_bin(events(spark, sf), "second", KEYS)


@query("u7_species_grid", views("SELECT * FROM species_grid"))
def u7(spark, sf):
    return G.species_grid(spans(spark, sf), events(spark, sf), "minute", KEYS)


@query("j12_gap_fill", views("SELECT * FROM filled"))
def j12(spark, sf):
    clicks = events(spark, sf)
    counts = G.clicks_per_species(G.high_and_moderate(clicks), "minute", KEYS)
    return G.fill_between(G.species_spans(spans(spark, sf), clicks, KEYS), counts, "minute", [*KEYS, "species"], ["nclicks", "duration"])


# The second grid, as sums over its hours.
SECONDS = """
SELECT s.pod_file, unnest(generate_series(date_trunc('second', s.start_at), s.end_at, INTERVAL 1 SECOND)) AS time FROM spans s"""
SECOND_COUNTS = """
SELECT pod_file, date_trunc('second', time) AS time, species, count(*) AS nclicks, CAST(sum(duration) AS BIGINT) AS duration
FROM k WHERE quality IN (2, 3) GROUP BY ALL"""


@query(
    "u7_species_grid_seconds",
    views(
        f"""SELECT pod_file, date_trunc('hour', time) AS hour, species, count(*) AS n
FROM ({SECONDS}) g JOIN (SELECT DISTINCT pod_file, species FROM k) p USING (pod_file) GROUP BY ALL"""
    ),
)
def u7_seconds(spark, sf):
    grid = G.species_grid(spans(spark, sf), events(spark, sf), "second", KEYS)
    return grid.groupBy("pod_file", G.truncate("hour", F.col("time")).alias("hour"), "species").agg(F.count("*").alias("n"))


@query(
    "c3_detection_positive_seconds",
    views(
        f"""SELECT g.pod_file, date_trunc('hour', g.time) AS hour, CAST(sum(coalesce(c.nclicks, 0)) AS BIGINT) AS nclicks,
       CAST(sum(coalesce(c.duration, 0) * 1000) AS BIGINT) AS milliseconds, count(c.nclicks) AS dps, count(*) AS n, 3 AS quality
FROM ({SECONDS}) g JOIN (SELECT DISTINCT pod_file FROM k WHERE species = 'NBHF') p USING (pod_file)
LEFT JOIN (SELECT * FROM ({SECOND_COUNTS}) s WHERE species = 'NBHF') c ON c.pod_file = g.pod_file AND c.time = g.time GROUP BY ALL"""
    ),
)
def c3_seconds(spark, sf):
    """Detection-positive seconds, summed by hour; the grid itself has a row for every second."""
    rows = G.detection_positive(events(spark, sf), spans(spark, sf), "second", KEYS)
    return rows.groupBy("pod_file", G.truncate("hour", F.col("time")).alias("hour"), "quality").agg(
        F.sum("nclicks").alias("nclicks"), F.sum("milliseconds").alias("milliseconds"),
        F.sum("dps").cast("long").alias("dps"), F.count("*").alias("n"),
    )


@query(
    "c4_click_counts_second",
    views(
        f"""SELECT g.pod_file, date_trunc('hour', g.time) AS hour, CAST(sum(coalesce(c.n, 0)) AS BIGINT) AS nclicks, count(*) AS n
FROM ({SECONDS}) g LEFT JOIN (SELECT pod_file, date_trunc('second', time) AS time, count(*) AS n FROM k GROUP BY ALL) c
ON c.pod_file = g.pod_file AND c.time = g.time GROUP BY ALL"""
    ),
)
def c4_second(spark, sf):
    rows = G.click_counts(events(spark, sf), spans(spark, sf), "second", KEYS)
    return rows.groupBy("pod_file", G.truncate("hour", F.col("time")).alias("hour")).agg(
        F.sum("nclicks").alias("nclicks"), F.count("*").alias("n")
    )


@query(
    "c4_click_counts_hour",
    views(
        """SELECT g.pod_file, g.time, coalesce(c.n, 0) AS nclicks
FROM (SELECT s.pod_file, unnest(generate_series(date_trunc('hour', s.start_at), s.end_at, INTERVAL 1 HOUR)) AS time FROM spans s) g
LEFT JOIN (SELECT pod_file, date_trunc('hour', time) AS time, count(*) AS n FROM k GROUP BY ALL) c ON c.pod_file = g.pod_file AND c.time = g.time"""
    ),
)
def c4_hour(spark, sf):
    return G.click_counts(events(spark, sf), spans(spark, sf), "hour", KEYS)


HOURS = """
SELECT pod_file, date_trunc('hour', time) AS time, species, CAST(sum(duration) AS BIGINT) AS milliseconds,
       CAST(sum(CAST(nclicks > 0 AS INT)) AS BIGINT) AS dpm, CAST(sum(CAST(nclicks > 0 AS INT)) > 0 AS INT) AS dph FROM filled GROUP BY 1, 2, 3"""


@query("g13_hour_rollup", views(HOURS))
def g13(spark, sf):
    filled = j12(spark, sf).withColumn("dpm", (F.col("nclicks") > 0).cast("int"))
    return G.hour_rollup(filled.withColumnRenamed("duration", "milliseconds"), KEYS)


@query(
    "c3_detection_positive_minutes",
    views(
        """SELECT pod_file, time, species, nclicks, duration * 1000 AS milliseconds, CAST(nclicks > 0 AS INT) AS dpm, 3 AS quality
FROM filled WHERE species = 'NBHF'"""
    ),
)
def c3(spark, sf):
    return G.detection_positive(events(spark, sf), spans(spark, sf), "minute", KEYS)


@query(
    "c3_detection_positive_hours",
    views(f"SELECT pod_file, time, species, milliseconds * 1000 AS milliseconds, dpm, dph, 3 AS quality FROM ({HOURS}) h"),
)
def c3_hours(spark, sf):
    return G.detection_positive(events(spark, sf), spans(spark, sf), "hour", KEYS, only_nbhf=False)


COUNTS = """
SELECT pod_file, time, coalesce(n, 0) AS nclicks FROM grid
FULL JOIN (SELECT pod_file, date_trunc('minute', time) AS time, count(*) AS n FROM k GROUP BY ALL) c USING (pod_file, time)"""


@query("c4_click_counts", views(COUNTS))
def c4(spark, sf):
    return G.click_counts(events(spark, sf), spans(spark, sf), "minute", KEYS)


@query(
    "j14_detections_with_noise",
    views(
        f"""SELECT f.pod_file, f.time, f.species, f.nclicks, f.duration * 1000 AS milliseconds, CAST(f.nclicks > 0 AS INT) AS dpm, 3 AS quality, c.nclicks AS nall
FROM filled f JOIN ({COUNTS}) c USING (pod_file, time) WHERE f.species = 'NBHF'"""
    ),
)
def j14(spark, sf):
    return G.with_noise(c3(spark, sf), c4(spark, sf), KEYS)


# ---- comparison with a vendor export

BOTH = """
SELECT coalesce(v.pod_file, o.pod_file) AS pod_file, coalesce(v.dt, o.dt) AS dt, v.n AS vendor_nall, o.n AS our_nall, v.n - o.n AS nall_diff
FROM (SELECT pod_file, dt, coalesce(nall_m, 0) AS n FROM fx_vendor) v
FULL JOIN (SELECT pod_file, DETECTION_DATE_TIME AS dt, CAST(sum(NUMBER_CLICKS_TOTAL) AS DOUBLE) / 3 AS n FROM fx_ours GROUP BY 1, 2) o
  ON o.dt = v.dt AND o.pod_file = v.pod_file"""


def compared(body: str) -> str:
    return with_views(body, "fx_vendor", "fx_ours", extra={"compared": BOTH})


def sides(spark, sf):
    return X.our_minutes(spark, sf), X.vendor(spark, sf)


@query(
    "j9_missing_minutes",
    compared("SELECT count(*) FILTER (our_nall IS NULL) AS missing_in_ours, count(*) FILTER (vendor_nall IS NULL) AS missing_in_vendor FROM compared"),
)
def j9(spark, sf):
    return C.missing_minutes(*sides(spark, sf), KEYS)


@query("j10_count_mismatches", compared("SELECT * FROM compared WHERE nall_diff <> 0"))
def j10(spark, sf):
    return C.mismatches(*sides(spark, sf), KEYS)


@query("o3_first_mismatches", compared("SELECT * FROM compared WHERE nall_diff <> 0 ORDER BY dt, pod_file LIMIT 10"))
def o3(spark, sf):
    return C.first_mismatches(*sides(spark, sf), KEYS)


@query("g11_click_totals", compared("SELECT pod_file, dt, our_nall FROM compared WHERE our_nall IS NOT NULL"))
def g11(spark, sf):
    return C.click_totals(X.our_minutes(spark, sf), KEYS)


@query(
    "g16_row_count_difference",
    compared("SELECT (SELECT count(*) FROM fx_vendor) - (SELECT count(*) FROM fx_ours) / 3.0::DOUBLE AS row_difference"),
)
def g16(spark, sf):
    return C.row_count_difference(*sides(spark, sf))


@query(
    "r2_reconcile",
    compared(
        """SELECT (SELECT count(*) FROM fx_vendor) - (SELECT count(*) FROM fx_ours) / 3.0::DOUBLE AS row_difference,
       count(*) FILTER (our_nall IS NULL) AS missing_in_ours, count(*) FILTER (vendor_nall IS NULL) AS missing_in_vendor,
       count(*) FILTER (nall_diff <> 0) AS n_mismatch, CASE WHEN count(*) FILTER (nall_diff <> 0) = 0 THEN 'PASS' ELSE 'FAIL' END AS verdict FROM compared"""
    ),
)
def r2(spark, sf):
    return C.reconcile(*sides(spark, sf), KEYS)

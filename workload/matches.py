"""Queries that bring files, deployments and detections together."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickloom.functions import filenames as N
from clickloom.operators import detections as D, matching as M
from workload import fixtures as X
from workload.fixtures import with_views
from workload.registry import query

TRAIN_FILES = """
SELECT sel_no, path, name_ext, bytes, core, CASE WHEN y <> '' THEN TRY_CAST(y || '-' || m || '-' || d AS DATE) END AS day, s AS serial
FROM (SELECT *, regexp_extract(core, '(?:^|[^A-Za-z0-9_])([0-9]{4})\\s+([0-9]{2})\\s+([0-9]{2})(?:[^A-Za-z0-9_]|$)', 1) AS y,
             regexp_extract(core, '(?:^|[^A-Za-z0-9_])([0-9]{4})\\s+([0-9]{2})\\s+([0-9]{2})(?:[^A-Za-z0-9_]|$)', 2) AS m,
             regexp_extract(core, '(?:^|[^A-Za-z0-9_])([0-9]{4})\\s+([0-9]{2})\\s+([0-9]{2})(?:[^A-Za-z0-9_]|$)', 3) AS d,
             regexp_extract(core, '(?i)(?:F?C?POD)[_\\s]*([0-9]+)', 1) AS s
      FROM (SELECT *, regexp_replace(name_ext, '\\.[^.]+$', '') AS core FROM {source} WHERE regexp_matches(lower(name_ext), '\\.[cf]p3$')) a) b"""
SPANS = """
SELECT row_no, station_name, receiver, regexp_extract(receiver, '([0-9]+)', 1) AS id, activation_day AS a, deploy_day AS d, valid_until_day AS v,
       concat(station_name, ' ', strftime(deploy_day, '%Y %m %d'), ' POD', regexp_extract(receiver, '([0-9]+)', 1)) AS DeploymentID
FROM fx_deployments"""
RANGE = "f.day < s.v AND ((f.day >= s.a AND f.day < s.d) OR (f.day >= s.d AND f.day > s.a))"
PAIRS = f"SELECT s.row_no, f.sel_no, f.name_ext FROM train_files f JOIN spans s ON f.serial = s.id AND {RANGE}"


def views(body: str, source: str = "fx_file_list", **more: str) -> str:
    extra = {"train_files": TRAIN_FILES.replace("{source}", source), "spans": SPANS, "pairs": PAIRS, **more}
    return with_views(body, source, "fx_deployments", extra=extra)


def index(spark, sf, files=None, **options):
    return M.match_index(files or X.file_list(spark, sf), X.conformed_deployments(spark, sf), **options)


def odd_index(spark, sf):
    return index(spark, sf, X.odd_file_list(spark, sf))


@query("j1_match_pairs", views("SELECT row_no, sel_no, name_ext FROM pairs"))
def j1(spark, sf):
    return M.match_pairs(index(spark, sf))


@query("j1_match_pairs_odd_names", views("SELECT row_no, sel_no, name_ext FROM pairs", "fx_odd_files"))
def j1_odd(spark, sf):
    return M.match_pairs(odd_index(spark, sf))


@query(
    "j1_match_pairs_inclusive",
    views("SELECT s.row_no, f.sel_no, f.name_ext FROM train_files f JOIN spans s ON f.serial = s.id AND f.day >= least(s.a, s.d) AND f.day < s.v"),
)
def j1_inclusive(spark, sf):
    return M.match_pairs(index(spark, sf, inclusive=True))


SHORT = "substr(id, 1, 3)"


@query(
    "j1_match_pairs_contains",
    views(
        f"""SELECT s.row_no, f.sel_no, f.name_ext FROM train_files f JOIN (SELECT * REPLACE ({SHORT} AS id) FROM spans) s
ON (contains(f.core, 'POD' || s.id) OR contains(f.core, 'FPOD_' || s.id)) AND {RANGE}""",
        "fx_odd_files",
    ),
)
def j1_contains(spark, sf):
    """Receiver numbers cut to three digits match every longer serial they start."""
    short = X.conformed_deployments(spark, sf).withColumn(
        "RECEIVER", F.concat(F.lit("C-POD-"), F.substring(M.receiver_serial(F.col("RECEIVER")), 1, 3))
    )
    return M.match_pairs(M.match_index(X.odd_file_list(spark, sf), short, mode="contains"))


@query(
    "j1_matched_file_lists",
    views(
        f"""SELECT row_no, (pos - 1) // {M.LIST_FILES} AS list_no, string_agg(name_ext, '|' ORDER BY pos) AS files
FROM (SELECT *, row_number() OVER (PARTITION BY row_no ORDER BY sel_no) AS pos FROM pairs) p GROUP BY ALL"""
    ),
)
def j1_lists(spark, sf):
    lists = M.file_lists(M.match_pairs(index(spark, sf)))
    return lists.select("row_no", "list_no", F.array_join("MatchingFiles", "|").alias("files"))


ANNOTATED = """
SELECT s.row_no, CASE WHEN n > 0 THEN s.id ELSE s.receiver END AS RECEIVER, coalesce(n, 0) AS MatchCount,
       CASE WHEN last LIKE '%.CP3' THEN 'C-POD' WHEN last LIKE '%.FP3' THEN 'F-POD' ELSE '' END AS PodType, 'metadata' AS RowType, s.DeploymentID,
       s.d, s.v
FROM spans s LEFT JOIN (SELECT row_no, count(*) AS n, arg_max(upper(name_ext), sel_no) AS last FROM pairs GROUP BY row_no) p USING (row_no)"""
ANNOTATION = "row_no, RECEIVER, MatchCount, PodType, RowType, DeploymentID"


@query("c8_annotated_deployments", views(f"SELECT {ANNOTATION} FROM annotated", "fx_odd_files", annotated=ANNOTATED))
def c8(spark, sf):
    matched = M.annotate(X.conformed_deployments(spark, sf), odd_index(spark, sf))
    return matched.select(*ANNOTATION.split(", "))


FILE_ONLY = """
SELECT 'file-only' AS RowType, arg_max(name_ext, sel_no) AS FileName, 0::BIGINT AS MatchCount,
       CASE WHEN lower(name_ext) LIKE '%.cp3' THEN 'C-POD' ELSE 'F-POD' END AS PodType
FROM train_files WHERE lower(name_ext) NOT IN (SELECT lower(name_ext) FROM pairs) GROUP BY lower(name_ext)"""


@query("j2_unmatched_files", views(f"SELECT RowType, FileName, MatchCount, PodType FROM ({FILE_ONLY}) f ORDER BY lower(FileName)", "fx_odd_files"))
def j2(spark, sf):
    return M.file_only_rows(X.odd_file_list(spark, sf), odd_index(spark, sf)).orderBy("lower_name").drop("lower_name")


@query(
    "c8_match_deployments",
    views(
        f"""SELECT {ANNOTATION}, CAST(NULL AS VARCHAR) AS FileName FROM annotated
UNION ALL SELECT NULL, NULL, MatchCount, PodType, RowType, NULL, FileName FROM ({FILE_ONLY}) f""",
        "fx_odd_files",
        annotated=ANNOTATED,
    ),
    gaps=("row_no",),
)
def c8_all(spark, sf):
    rows = M.match_deployments(X.odd_file_list(spark, sf), X.conformed_deployments(spark, sf), odd_index(spark, sf))
    return rows.select(*ANNOTATION.split(", "), "FileName")


@query("j3_first_deployment", views("SELECT lower(name_ext) AS lower_name, min(row_no) AS row_no FROM pairs GROUP BY lower(name_ext)"))
def j3(spark, sf):
    return M.first_deployment(index(spark, sf))


@query(
    "j4_name_to_path",
    views(
        """SELECT upper(f.name_ext) AS name_ext, f.sel_no, p.path FROM train_files f
JOIN (SELECT lower(name_ext) AS l, arg_min(path, sel_no) AS path FROM fx_file_list GROUP BY 1) p ON p.l = lower(f.name_ext)
WHERE lower(f.name_ext) IN (SELECT lower(name_ext) FROM pairs)"""
    ),
)
def j4(spark, sf):
    """Names in another case still find their path."""
    files = X.file_list(spark, sf)
    chosen = M.train_files(files).withColumn("name_ext", F.upper("name_ext"))
    matched = index(spark, sf, files)
    listed = M.process_list(chosen, files, matched, M.annotate(X.conformed_deployments(spark, sf), matched))
    return listed.select("name_ext", "sel_no", "path")


@query(
    "o2_selection_order",
    views(
        """SELECT f.sel_no, f.name_ext, p.row_no, s.DeploymentID AS deployment_id, CAST(s.d AS TIMESTAMP) AS deploy, CAST(s.v AS TIMESTAMP) AS valid_until
FROM train_files f JOIN (SELECT lower(name_ext) AS l, min(row_no) AS row_no FROM pairs GROUP BY 1) p ON p.l = lower(f.name_ext) JOIN spans s ON s.row_no = p.row_no ORDER BY f.sel_no"""
    ),
)
def o2(spark, sf):
    files = X.file_list(spark, sf)
    matched = index(spark, sf, files)
    listed = M.process_list(M.train_files(files), files, matched, M.annotate(X.conformed_deployments(spark, sf), matched))
    return listed.drop("path").orderBy("sel_no")


RECEIVERS = """
SELECT 'CHELONIA' AS RCV_MANUFACTURER, RECEIVER AS RECEIVER_ID_SERIAL_NUMBER, arg_min(PodType, row_no) AS RECEIVER_MODEL, 'Active' AS RCV_STATUS
FROM annotated WHERE MatchCount > 0 GROUP BY RECEIVER"""


@query("r1_receivers", views(RECEIVERS, "fx_odd_files", annotated=ANNOTATED))
def r1(spark, sf):
    return M.receivers(M.annotate(X.conformed_deployments(spark, sf), odd_index(spark, sf)))


@query(
    "g15_distinct_receivers",
    with_views("SELECT receiver AS RECEIVER_ID_SERIAL_NUMBER, min(row_no) AS row_no FROM fx_deployments GROUP BY receiver", "fx_deployments"),
)
def g15(spark, sf):
    rows = X.conformed_deployments(spark, sf).select("row_no", F.col("RECEIVER").alias("RECEIVER_ID_SERIAL_NUMBER"))
    return M.first_row(["RECEIVER_ID_SERIAL_NUMBER"], [F.col("row_no")], rows)


FLAGS = """
SELECT p_partkey AS row_no, POD_FILE, CASE WHEN POD_FILE IN (SELECT name_ext FROM fx_file_list) THEN 'Y' ELSE 'N' END AS MATCH FROM metadata
UNION ALL SELECT NULL, name_ext, 'N' FROM fx_file_list WHERE name_ext NOT IN (SELECT POD_FILE FROM metadata)"""


@query(
    "j11_exact_name_flag",
    with_views(
        FLAGS, "fx_file_list",
        extra={"metadata": "SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN lower(name_ext) ELSE name_ext END AS POD_FILE FROM fx_files WHERE kind = 3"},
    ),
    gaps=("row_no",),
)
def j11(spark, sf):
    name = F.when(F.col("p_partkey") % 5 == 0, F.lower("name_ext")).otherwise(F.col("name_ext"))
    metadata = X.files(spark, sf).filter("kind = 3").select(F.col("p_partkey").alias("row_no"), name.alias("POD_FILE"))
    return M.exact_name_flags(metadata, X.file_list(spark, sf)).select("row_no", "POD_FILE", "MATCH")


# ---- detections of matched files

LABELS = """
SELECT pod_file, concat('ST', substr(pod_file, 3, 1), ' 2024 01 01 POD', substr(pod_file, 20, 3)) AS deployment_id,
       min(minute_start) + INTERVAL 2 DAY AS deploy, max(minute_start) - INTERVAL 3 DAY AS valid_until FROM fx_clicks GROUP BY pod_file"""
MINUTE_ROWS = "SELECT pod_file, minute_start, count(*) AS n FROM fx_clicks GROUP BY pod_file, minute_start"


def minute_rows(spark, sf):
    return X.clicks(spark, sf).groupBy(
        F.col("pod_file").alias("filename"), F.col("minute_start").alias("DETECTION_DATE_TIME")
    ).agg(F.count("*").alias("NUMBER_CLICKS_TOTAL"))


def labels(spark, sf):
    name = F.col("pod_file")
    made = F.concat(F.lit("ST"), F.substring(name, 3, 1), F.lit(" 2024 01 01 POD"), F.substring(name, 20, 3))
    spans = X.clicks(spark, sf).groupBy("pod_file").agg(F.min("minute_start").alias("a"), F.max("minute_start").alias("b"))
    return spans.select(
        "pod_file", made.alias("deployment_id"),
        (F.col("a") + F.expr("INTERVAL 2 DAY")).alias("deploy"),
        (F.col("b") - F.expr("INTERVAL 3 DAY")).alias("valid_until"),
    )


@query(
    "p8_relabel",
    with_views(
        "SELECT m.pod_file AS PODfile, l.deployment_id AS filename, m.minute_start AS DETECTION_DATE_TIME, m.n AS NUMBER_CLICKS_TOTAL FROM minute_rows m JOIN labels l USING (pod_file)",
        "fx_clicks", extra={"labels": LABELS, "minute_rows": MINUTE_ROWS},
    ),
)
def p8(spark, sf):
    return D.relabel(minute_rows(spark, sf), labels(spark, sf)).drop("deploy", "valid_until")


@query(
    "p7_time_range_clip",
    with_views(
        """SELECT m.pod_file AS PODfile, m.minute_start AS DETECTION_DATE_TIME, m.n AS NUMBER_CLICKS_TOTAL FROM minute_rows m JOIN labels l USING (pod_file)
WHERE m.minute_start >= l.deploy AND m.minute_start <= l.valid_until""",
        "fx_clicks", extra={"labels": LABELS, "minute_rows": MINUTE_ROWS},
    ),
)
def p7(spark, sf):
    rows = D.clip(D.relabel(minute_rows(spark, sf), labels(spark, sf)))
    return rows.select("PODfile", "DETECTION_DATE_TIME", "NUMBER_CLICKS_TOTAL")


SPAN_SQL = """
SELECT pod_file AS PODfile, min(minute_start) AS first_time, max(minute_start) AS last_time,
       date_diff('second', min(minute_start), max(minute_start)) AS span_seconds FROM fx_clicks GROUP BY pod_file"""


@query("g10_detection_span", with_views(SPAN_SQL, "fx_clicks"))
def g10(spark, sf):
    return M.detection_spans(minute_rows(spark, sf).withColumnRenamed("filename", "PODfile"))


def file_spans(spark, sf):
    """Detection times of the regularly named files, two per file; odd names have none."""
    epoch = F.lit("2022-01-01 00:00:00").cast("timestamp_ntz")
    two = M.train_files(X.file_list(spark, sf)).withColumn("step", F.explode(F.array(F.lit(0), F.lit(977))))
    return two.select(
        N.stem(F.col("name_ext")).alias("PODfile"),
        F.timestamp_add("SECOND", F.col("sel_no") * (F.col("step") + 1), epoch).alias("DETECTION_DATE_TIME"),
    )


OVERVIEW = """
SELECT f.sel_no, f.core AS Filename, CASE WHEN o.text IS NULL THEN 'No' ELSE 'Yes' END AS MetadataMatch, coalesce(o.text, 'N/A') AS MetadataDeployment,
       coalesce(s.text, 'N/A') AS DetectionSpan, coalesce(st.status, 'NOT ATTEMPTED') AS Status
FROM train_files f
LEFT JOIN (SELECT core, printf('%d days, 0 hours, 0 minutes', CAST(v - d AS BIGINT)) AS text
           FROM (SELECT regexp_replace(name_ext, '\\.[^.]+$', '') AS core, min(row_no) AS row_no FROM pairs GROUP BY 1) p JOIN spans USING (row_no)) o ON o.core = f.core
LEFT JOIN (SELECT core, printf('%d days, %d hours, %d minutes', s // 86400, (s % 86400) // 3600, (s % 3600) // 60) AS text
           FROM (SELECT regexp_replace(name_ext, '\\.[^.]+$', '') AS core, max(sel_no * 978) - min(sel_no) AS s
                 FROM fx_file_list WHERE name_ext LIKE '%.CP3' GROUP BY 1) g) s ON s.core = f.core
LEFT JOIN (SELECT core, CASE WHEN min(bytes) < 40000 THEN 'FAILED' ELSE 'OK' END AS status FROM train_files GROUP BY core) st ON st.core = f.core"""


def overview(spark, sf):
    train = M.train_files(X.odd_file_list(spark, sf))
    status = train.groupBy(N.stem(F.col("name_ext")).alias("pod_file")).agg(
        F.when(F.min("bytes") < 40_000, "FAILED").otherwise("OK").alias("status")
    )
    return M.file_overview(
        train, odd_index(spark, sf), X.conformed_deployments(spark, sf), M.detection_spans(file_spans(spark, sf)), status
    )


@query("c9_file_overview", views(OVERVIEW, "fx_odd_files"))
def c9(spark, sf):
    return overview(spark, sf)


@query("j13_overview_deployment", views(f"SELECT sel_no, Filename, MetadataMatch, MetadataDeployment FROM ({OVERVIEW}) o", "fx_odd_files"))
def j13(spark, sf):
    return overview(spark, sf).select("sel_no", "Filename", "MetadataMatch", "MetadataDeployment")

"""Queries over deployment sheets."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickloom import spec as S
from clickloom.functions import text as T
from clickloom.operators import deployments as P, matching as M
from workload import fixtures as X
from workload.fixtures import with_views
from workload.registry import query

ASSEMBLED = (
    "TRY_CAST(concat(ACTIVATION_YEAR, '-', lpad(ACTIVATION_MONTH, 2, '0'), '-', lpad(ACTIVATION_DAY, 2, '0'), ' ', "
    "CASE WHEN ACTIVATION_TIME LIKE '_:%' THEN '0' ELSE '' END, ACTIVATION_TIME, "
    "CASE WHEN len(ACTIVATION_TIME) - len(replace(ACTIVATION_TIME, ':', '')) = 1 THEN ':00' ELSE '' END) AS TIMESTAMP)"
)


@query("p1_assemble_timestamps", with_views(f"SELECT row_no, {ASSEMBLED} AS ACTIVATION_DATE_TIME FROM fx_deployments_text", "fx_deployments_text"))
def p1(spark, sf):
    return P.assemble_dates(X.deployments_text(spark, sf)).select("row_no", "ACTIVATION_DATE_TIME")


@query(
    "p2_upper_names",
    with_views(
        "SELECT row_no AS ROW_NO, rcv_project AS RCV_PROJECT, receiver AS RECEIVER, station_name AS STATION_NAME, "
        "CAST(activation_day AS VARCHAR) AS ACTIVATION_DAY, CAST(deploy_day AS VARCHAR) AS DEPLOY_DAY, CAST(valid_until_day AS VARCHAR) AS VALID_UNTIL_DAY, deploy_lat AS DEPLOY_LAT, deploy_long AS DEPLOY_LONG FROM fx_deployments",
        "fx_deployments",
    ),
)
def p2(spark, sf):
    days = {c: F.col(c).cast("string") for c in ("activation_day", "deploy_day", "valid_until_day")}
    return P.upper_names(X.deployments(spark, sf).withColumns(days))


def sheet(spark, sf):
    """Assembled sheet with optional columns in several states: blank, missing, the word nan, filled."""
    row = F.col("row_no")
    state = F.when(row % 4 == 0, "  ").when(row % 4 == 1, F.lit(None)).when(row % 4 == 2, "nan")
    return P.assemble_dates(X.deployments_text(spark, sf)).withColumns(
        {
            "COMMENTS": state.otherwise(F.concat(F.lit("c"), row.cast("string"))),
            "DOWNLOAD_DATE_TIME": state.otherwise("2022-10-13 09:00:00"),
            "DEPLOY_DATE_TIME": F.col("ACTIVATION_DATE_TIME") + F.expr("INTERVAL 1 DAY"),
            "VALID_DATA_UNTIL_DATE_TIME": F.col("ACTIVATION_DATE_TIME") + F.expr("INTERVAL 60 DAY"),
            "EXTRA": F.lit("x"),
        }
    )


STATE = "CASE row_no % 4 WHEN 0 THEN '  ' WHEN 1 THEN NULL WHEN 2 THEN 'nan' ELSE {} END"
SHEET = f"""
SELECT *, {STATE.format("concat('c', CAST(row_no AS VARCHAR))")} AS COMMENTS, {STATE.format("'2022-10-13 09:00:00'")} AS DOWNLOAD_DATE_TIME,
       {ASSEMBLED} AS ACTIVATION_DATE_TIME FROM fx_deployments_text"""


def conform_sql(marker: str, project: str) -> str:
    absent = {c: f"'{marker}'" for c in S.OUTPUT_ORDER}
    absent.update({c: "CAST(NULL AS TIMESTAMP)" for c in S.DATETIMES})
    absent.update({c: c for c in ("RECEIVER", "STATION_NAME", "DEPLOY_LAT", "DEPLOY_LONG", "ACTIVATION_DATE_TIME")})
    absent["RCV_PROJECT"] = project
    absent["DEPLOY_DATE_TIME"] = "ACTIVATION_DATE_TIME + INTERVAL 1 DAY"
    absent["VALID_DATA_UNTIL_DATE_TIME"] = "ACTIVATION_DATE_TIME + INTERVAL 60 DAY"
    absent["COMMENTS"] = f"CASE WHEN trim(coalesce(COMMENTS, '')) = '' THEN '{marker}' ELSE COMMENTS END"
    absent["DOWNLOAD_DATE_TIME"] = "CASE WHEN trim(DOWNLOAD_DATE_TIME) IN ('', 'nan') THEN NULL ELSE DOWNLOAD_DATE_TIME END"
    return with_views(
        "SELECT row_no, " + ", ".join(f"{v} AS {k}" for k, v in absent.items()) + " FROM sheet",
        "fx_deployments_text",
        extra={"sheet": SHEET},
    )


@query("p3_conform_columns", conform_sql("Na", "RCV_PROJECT"))
def p3(spark, sf):
    return P.conform(sheet(spark, sf))


@query(
    "p4_standardise_empties",
    with_views(
        """SELECT row_no, CASE WHEN trim(coalesce(COMMENTS, '')) = '' THEN 'Na' ELSE COMMENTS END AS COMMENTS,
       CASE WHEN trim(DOWNLOAD_DATE_TIME) IN ('', 'nan') THEN NULL ELSE DOWNLOAD_DATE_TIME END AS DOWNLOAD_DATE_TIME FROM sheet""",
        "fx_deployments_text",
        extra={"sheet": SHEET},
    ),
)
def p4(spark, sf):
    return P.conform(sheet(spark, sf)).select("row_no", "COMMENTS", "DOWNLOAD_DATE_TIME")


@query("p5_export_variant", conform_sql("NaN", "CASE WHEN trim(RCV_PROJECT) = '' THEN 'NaN' ELSE RCV_PROJECT END"))
def p5(spark, sf):
    return P.conform(sheet(spark, sf), marker=S.EXPORT_MARKER, all_columns=True)


@query(
    "p6_project_filter",
    with_views("SELECT row_no, RECEIVER FROM fx_deployments_text WHERE trim(RCV_PROJECT) = 'BUILDING'", "fx_deployments_text"),
)
def p6(spark, sf):
    return P.of_project(X.deployments_text(spark, sf), " BUILDING ").select("row_no", "RECEIVER")


@query(
    "v2_empty_mandatory_values",
    with_views(
        """SELECT 'RCV_PROJECT' AS column_name, count(*) FILTER (trim(RCV_PROJECT) IN ('', 'nan')) AS n_empty FROM fx_deployments_text
UNION ALL SELECT 'RECEIVER', count(*) FILTER (trim(RECEIVER) = '') FROM fx_deployments_text
UNION ALL SELECT 'STATION_NAME', count(*) FILTER (trim(STATION_NAME) = '') FROM fx_deployments_text
UNION ALL SELECT 'DEPLOY_LAT', count(*) FILTER (DEPLOY_LAT IS NULL) FROM fx_deployments_text
UNION ALL SELECT 'DEPLOY_LONG', count(*) FILTER (DEPLOY_LONG IS NULL) FROM fx_deployments_text""",
        "fx_deployments_text",
    ),
)
def v2(spark, sf):
    return P.empty_counts(X.deployments_text(spark, sf))


@query(
    "v1_missing_mandatory_columns",
    with_views(
        """SELECT unnest(['ACTIVATION_DATE_TIME', 'DEPLOY_DATE_TIME', 'VALID_DATA_UNTIL_DATE_TIME']) AS column_name, n AS n_rows
FROM (SELECT count(*) AS n FROM fx_deployments_text) c""",
        "fx_deployments_text",
    ),
)
def v1(spark, sf):
    return P.missing_column_rows(X.deployments_text(spark, sf))


MIN_DATE = "2022-03-01 00:00:00"


def dated(spark, sf):
    """Deployments with recovery dates that are at times too early or missing."""
    row = F.col("row_no")
    recover = F.date_add(F.to_date("DEPLOY_DATE_TIME"), (row % 40 - 10).cast("int")).cast("timestamp_ntz")
    return X.conformed_deployments(spark, sf).withColumns(
        {"RECOVER_DATE_TIME": F.when(row % 9 != 0, recover), "VALID_DATA_UNTIL_DATE_TIME": F.when(
            row % 13 == 0, F.date_sub(F.to_date("ACTIVATION_DATE_TIME"), 1).cast("timestamp_ntz")
        ).otherwise(F.col("VALID_DATA_UNTIL_DATE_TIME"))}
    )


DATED = """
SELECT row_no, activation_day AS a, deploy_day AS d, CASE WHEN row_no % 13 = 0 THEN activation_day - 1 ELSE valid_until_day END AS v,
       CASE WHEN row_no % 9 <> 0 THEN deploy_day + CAST(row_no % 40 - 10 AS INT) END AS r FROM fx_deployments"""


@query(
    "v3_dates_after_minimum",
    with_views(
        "SELECT 'V3' AS check_id, row_no, c AS column_name, printf('Row %d: %s is earlier than minDate.', row_no, c) AS message FROM ("
        + " UNION ALL ".join(
            f"SELECT row_no, '{name}' AS c, {k} AS t FROM dated"
            for name, k in (("ACTIVATION_DATE_TIME", "a"), ("DEPLOY_DATE_TIME", "d"), ("VALID_DATA_UNTIL_DATE_TIME", "v"), ("RECOVER_DATE_TIME", "r"))
        )
        + f") u WHERE t < TIMESTAMP '{MIN_DATE}'",
        "fx_deployments",
        extra={"dated": DATED},
    ),
)
def v3(spark, sf):
    columns = ("ACTIVATION_DATE_TIME", "DEPLOY_DATE_TIME", "VALID_DATA_UNTIL_DATE_TIME", "RECOVER_DATE_TIME")
    return P.violation_rows(dated(spark, sf), P.date_cases(MIN_DATE, columns))


@query(
    "v4_date_order",
    with_views(
        """SELECT 'V4' AS check_id, row_no, c AS column_name, m AS message FROM (
SELECT row_no, 'DEPLOY_DATE_TIME' AS c, 'Deployment date must be before recovery date.' AS m FROM dated WHERE d > r
UNION ALL SELECT row_no, 'ACTIVATION_DATE_TIME', 'Activation date must be before recovery date.' FROM dated WHERE a > r
UNION ALL SELECT row_no, 'ACTIVATION_DATE_TIME', 'Activation date must be before valid until date.' FROM dated WHERE a > v
UNION ALL SELECT row_no, 'DEPLOY_DATE_TIME', 'Deployment date must be before valid until date.' FROM dated WHERE d > v) u""",
        "fx_deployments",
        extra={"dated": DATED},
    ),
)
def v4(spark, sf):
    return P.violation_rows(dated(spark, sf), P.order_cases())


@query(
    "v5_coordinates",
    with_views(
        """SELECT 'V5' AS check_id, row_no, 'DEPLOY_LAT' AS column_name, printf('Row %d: ', row_no) || m AS message FROM (
SELECT row_no, CASE WHEN NOT la AND NOT lo THEN '- Invalid latitude and longitude.' WHEN NOT la THEN '- Invalid latitude.' WHEN NOT lo THEN '- Invalid longitude.' END AS m
FROM (SELECT row_no, coalesce(TRY_CAST(DEPLOY_LAT AS DOUBLE) * 10 BETWEEN -90 AND 90, FALSE) AS la,
             coalesce(TRY_CAST(DEPLOY_LONG AS DOUBLE) BETWEEN -180 AND 180, FALSE) AS lo FROM fx_deployments_text) c) u WHERE m IS NOT NULL""",
        "fx_deployments_text",
    ),
)
def v5(spark, sf):
    """Latitudes times ten, so that the input has values out of range on both axes."""
    wide = F.coalesce((F.col("DEPLOY_LAT").try_cast("double") * 10).cast("string"), F.col("DEPLOY_LAT"))
    return P.violation_rows(X.deployments_text(spark, sf).withColumn("DEPLOY_LAT", wide), P.coordinate_cases())


@query(
    "v6_single_project",
    with_views("SELECT DISTINCT trim(RCV_PROJECT) AS project FROM fx_deployments_text WHERE trim(RCV_PROJECT) NOT IN ('', 'nan')", "fx_deployments_text"),
)
def v6(spark, sf):
    return P.projects(X.deployments_text(spark, sf)).select("project")


@query(
    "g9_rows_per_project",
    with_views(
        """SELECT project, n, printf('%s (n=%d)', project, n) AS label FROM (SELECT trim(RCV_PROJECT) AS project, count(*) AS n FROM fx_deployments_text
WHERE trim(RCV_PROJECT) NOT IN ('', 'nan') GROUP BY trim(RCV_PROJECT)) g""",
        "fx_deployments_text",
    ),
)
def g9(spark, sf):
    return P.projects(X.deployments_text(spark, sf))


@query(
    "v10_option_check",
    with_views(
        """SELECT 'V10' AS check_id, row_no, 'RCV_PROJECT' AS column_name, printf('Row %d: %s is not an option of RCV_PROJECT.', row_no, RCV_PROJECT) AS message
FROM fx_deployments_text WHERE trim(RCV_PROJECT) NOT IN ('', 'nan') AND RCV_PROJECT NOT IN ('BUILDING', 'MACHINERY', 'Na')""",
        "fx_deployments_text",
    ),
)
def v10(spark, sf):
    return P.violation_rows(X.deployments_text(spark, sf), P.option_cases({"RCV_PROJECT": ("BUILDING", "MACHINERY")}))


@query(
    "f9_deployment_id",
    with_views(
        "SELECT row_no, concat(station_name, ' ', strftime(deploy_day, '%Y %m %d'), ' POD', regexp_extract(receiver, '([0-9]+)', 1)) AS DeploymentID FROM fx_deployments",
        "fx_deployments",
    ),
)
def f9(spark, sf):
    made = M.deployment_id(F.col("STATION_NAME"), F.col("DEPLOY_DATE_TIME"), F.col("RECEIVER"))
    return X.conformed_deployments(spark, sf).select("row_no", made.alias("DeploymentID"))


@query(
    "f10_receiver_serial",
    with_views("SELECT row_no, nullif(regexp_extract(receiver, '([0-9]+)', 1), '') AS serial FROM fx_deployments", "fx_deployments"),
)
def f10(spark, sf):
    return X.conformed_deployments(spark, sf).select("row_no", M.receiver_serial(F.col("RECEIVER")).alias("serial"))


@query(
    "f11_format_duration",
    with_views(
        """SELECT row_no, CASE WHEN s IS NULL THEN 'NaN' ELSE printf('%d days, %d hours, %d minutes', s // 86400, (s % 86400) // 3600, (s % 3600) // 60) END AS text
FROM (SELECT row_no, CASE WHEN row_no % 10 <> 0 THEN row_no * 7919 END AS s FROM fx_deployments) d""",
        "fx_deployments",
    ),
)
def f11(spark, sf):
    seconds = F.when(F.col("row_no") % 10 != 0, F.col("row_no") * 7919)
    return X.deployments(spark, sf).select("row_no", T.format_duration(seconds).alias("text"))


def mixed_dates(spark, sf):
    """The activation day written in seven ways, one of them no date."""
    row, day = F.col("row_no"), F.col("activation_day")
    shape = row % 7
    serial = F.datediff(day, F.lit("1899-12-30").cast("date")).cast("string")
    text = (
        F.when(shape == 0, F.date_format(day, "yyyy-MM-dd'T'08:43:00'Z'"))
        .when(shape == 1, F.date_format(day, "M/d/yyyy 8:43"))
        .when(shape == 2, F.date_format(day, "dd/MM/yyyy"))
        .when(shape == 3, F.concat(serial, F.lit(".25")))
        .when(shape == 4, "  ")
        .when(shape == 5, F.date_format(day, "'0022'-MM-dd 00:00:00"))
        .otherwise(F.concat(F.lit("about "), F.year(day).cast("string")))
    )
    return X.deployments(spark, sf).select("row_no", text.alias("raw"))


F14_SQL = """
SELECT row_no, raw, t AS parsed, CASE WHEN trim(raw) = '' THEN '' WHEN t IS NULL THEN '- Invalid datetime format. Please use format: yyyy-MM-ddTHH:mm:ssZ.'
       WHEN t < TIMESTAMP '2022-02-01' THEN 'Date earlier than allowed minimum.' ELSE '' END AS message
FROM (SELECT row_no, raw, CASE row_no % 7 WHEN 0 THEN strptime(raw, '%Y-%m-%dT%H:%M:%SZ') WHEN 1 THEN strptime(raw, '%m/%d/%Y %H:%M')
             WHEN 2 THEN CASE WHEN extract(day FROM activation_day) > 12 THEN strptime(raw, '%d/%m/%Y') ELSE strptime(raw, '%m/%d/%Y') END
             WHEN 3 THEN CAST(activation_day AS TIMESTAMP) + INTERVAL 6 HOUR END AS t
      FROM (SELECT row_no, activation_day, CASE row_no % 7 WHEN 0 THEN strftime(activation_day, '%Y-%m-%dT08:43:00Z') WHEN 1 THEN strftime(activation_day, '%-m/%-d/%Y 8:43')
                   WHEN 2 THEN strftime(activation_day, '%d/%m/%Y') WHEN 3 THEN concat(CAST(activation_day - DATE '1899-12-30' AS VARCHAR), '.25')
                   WHEN 4 THEN '  ' WHEN 5 THEN strftime(activation_day, '0022-%m-%d 00:00:00') ELSE concat('about ', CAST(extract(year FROM activation_day) AS VARCHAR)) END AS raw
            FROM fx_deployments) a) b"""


@query("f14_parse_mixed_dates", with_views(F14_SQL, "fx_deployments"))
def f14(spark, sf):
    parsed = T.parse_any_timestamp(F.col("raw"))
    return mixed_dates(spark, sf).withColumn("parsed", parsed).withColumn(
        "message", T.timestamp_error(F.col("raw"), F.col("parsed"), "2022-02-01 00:00:00")
    )


@query(
    "f16_split_timestamp",
    with_views(
        """SELECT row_no, CAST(extract(year FROM t) AS INT) AS DEPLOY_YEAR, CAST(extract(month FROM t) AS INT) AS DEPLOY_MONTH,
       CAST(extract(day FROM t) AS INT) AS DEPLOY_DAY, strftime(t, '%H:%M:%S') AS DEPLOY_TIME
FROM (SELECT row_no, deploy_day + to_seconds(row_no * 7919 % 86400) AS t FROM fx_deployments) d""",
        "fx_deployments",
    ),
)
def f16(spark, sf):
    moment = F.timestamp_add("SECOND", F.col("row_no") * 7919 % 86400, F.col("deploy_day").cast("timestamp_ntz"))
    rows = X.deployments(spark, sf).select("row_no", moment.alias("t"))
    return P.split_dates(rows, {"t": "DEPLOY"}).drop("t")


COORD = "CASE row_no % 4 WHEN 0 THEN CAST(row_no % 10 AS VARCHAR) || '.' || lpad(CAST(row_no % 10000 AS VARCHAR), 4, '0') WHEN 1 THEN ' 55.' || lpad(CAST(row_no AS VARCHAR), 5, '0') WHEN 2 THEN '5,' || CAST(row_no AS VARCHAR) ELSE '' END"


@query(
    "f17_normalise_coordinates",
    with_views(
        """SELECT row_no, n AS coordinate, CAST(n = '' OR regexp_matches(n, '^[0-9]{2}\\.[0-9]{5}$') AS INT) AS ok
FROM (SELECT row_no, CASE WHEN regexp_matches(c, '^[0-9]\\.[0-9]{4}$') THEN '0' || c || '0' ELSE trim(c) END AS n
      FROM (SELECT row_no, """ + COORD + " AS c FROM fx_deployments) a) b",
        "fx_deployments",
    ),
)
def f17(spark, sf):
    row = F.col("row_no")
    raw = (
        F.when(row % 4 == 0, F.concat((row % 10).cast("string"), F.lit("."), F.lpad((row % 10000).cast("string"), 4, "0")))
        .when(row % 4 == 1, F.concat(F.lit(" 55."), F.lpad(row.cast("string"), 5, "0")))
        .when(row % 4 == 2, F.concat(F.lit("5,"), row.cast("string")))
        .otherwise("")
    )
    rows = X.deployments(spark, sf).select("row_no", raw.alias("c"))
    return rows.select(
        "row_no", T.normalise_coordinate(F.col("c")).alias("coordinate"), T.coordinate_ok(F.col("c")).cast("int").alias("ok")
    )

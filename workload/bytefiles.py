"""Queries that read detector files, sheets and exports written from the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from itertools import chain, groupby, pairwise

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from clickloom import spec as S
from clickloom.functions import filenames as N, records as R
from clickloom.layout import LAYOUTS
from clickloom.operators import deployments as P, matching as M, segment as G
from clickloom.plans import harmonise as H, outputs as O
from clickloom.session import new_folder
from clickloom.sources import datasource as DS, files as I, records as Q
from workload import fixtures as X, matches, recordings as W
from workload.fixtures import with_views
from workload.registry import query

CLOCK_START = 45_292 * 1_440 + 1_200  # minutes from the clock base to 2024-01-01 20:00
FILES_START = "2024-01-01 20:00:00"
FPGA_VERSION = 900
_folders: dict[tuple[str, str], str] = {}


def _header(kind: str) -> bytes:
    header = np.zeros(LAYOUTS[kind].header_bytes, np.uint8)
    header[256:260] = np.frombuffer(int(CLOCK_START).to_bytes(4, "big"), np.uint8)
    header[64], header[65] = W.TILT_MIN, W.TILT_MAX
    header[39:41] = np.frombuffer(FPGA_VERSION.to_bytes(2, "big"), np.uint8)
    return header.tobytes()


def _body(kind: str, rows: pd.DataFrame) -> np.ndarray:
    layout = LAYOUTS[kind]
    body = np.zeros((len(rows), layout.record_bytes), np.uint8)
    for column in rows.columns:
        if column.startswith("b") and column[1:].isdigit():
            body[:, int(column[1:]) - 1] = rows[column].fillna(0).astype(np.uint8)
    ticks = (rows["time_us"].fillna(0).astype("int64") // 5).to_numpy()
    timed = rows["time_us"].notna().to_numpy()
    for i, shift in enumerate((16, 8, 0)):
        body[timed, i] = ((ticks >> shift) & 255)[timed]
    typed = ~timed if kind.startswith("FP") else np.ones(len(rows), bool)
    body[typed, layout.type_byte - 1] = rows["rec_type"].to_numpy()[typed]
    return body


def _file_bytes(kind: str, pieces: Iterable[pd.DataFrame], n: int) -> Iterator[bytes]:
    """The bytes of a file, piece by piece: header, records in order, and what a reader has to skip. CP1 needs their number ``n``."""
    skipped = b"\xff" * LAYOUTS[kind].record_bytes
    yield _header(kind)
    done, first = 0, b""
    for rows in pieces:
        body = _body(kind, rows)
        first = first or body[:1].tobytes()
        middle = n // 2 - done
        if kind == "CP1" and 0 <= middle < len(body):  # end marks anywhere do not count
            yield body[:middle].tobytes() + skipped + body[middle:].tobytes()
        else:
            yield body.tobytes()
        done += len(body)
    yield skipped + first if kind == "CP3" else skipped  # a CP3 file ends here; what follows is not part of it


def _pieces(parts: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Parts of a stream that is sorted by file, cut where a file begins."""
    for part in parts:
        names = part["pod_file"].to_numpy()
        for a, b in pairwise([0, *(np.flatnonzero(names[1:] != names[:-1]) + 1), len(part)]):
            if a < b:
                yield part.iloc[a:b]


def _write_files(rows: DataFrame, kind: str, folder: str) -> int:
    """Write one file per pod_file; returns the file count.

    Spark sorts the records; a task gets those of a file a batch at a time and writes them as they come, so that a long recording
    takes no more of a worker's memory than a short one. Where the middle of a file is asked for (CP1), the count of its records
    comes as the row before them.
    A file appears under its name only when complete, so a repeated task does no harm.
    """

    def write(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, base = Q.filesystem(folder)
        system.create_dir(base, recursive=True)
        for name, pieces in groupby(_pieces(parts), lambda piece: piece["pod_file"].iloc[0]):
            path = f"{base}/{name}.{kind}"
            draft = f"{path}.part-{uuid.uuid4().hex}"
            n = 0
            if kind == "CP1":
                piece = next(pieces)
                n, pieces = int(piece["n_records"].iloc[0]), chain([piece.iloc[1:]], pieces)
            with system.open_output_stream(draft) as sink:
                for data in _file_bytes(kind, pieces, n):
                    sink.write(data)
                size = sink.tell()
            system.move(draft, path)
            yield pd.DataFrame({"bytes": [size]})

    order = ["pod_file", F.asc_nulls_last("rec_no")]
    if kind == "CP1":
        rows = rows.unionByName(rows.groupBy("pod_file").agg(F.count("*").alias("n_records")), allowMissingColumns=True)
        order.insert(1, F.asc_nulls_last("n_records"))
    return rows.repartition("pod_file").sortWithinPartitions(*order).mapInPandas(write, "bytes long").count()


def named(records: DataFrame, family: str) -> DataFrame:
    """Records under the name their file gets."""
    return records.withColumn("pod_file", F.regexp_replace("pod_file", r" POD1", " FPOD_2")) if family == "FP" else records


def fp1_records(spark: SparkSession, sf: str) -> DataFrame:
    """An FP1 stream: the markers and clicks of the record view, with amplitude bytes from the click view."""
    hours = X.hours_of(spark, sf)
    marks = X.records(spark, sf).filter("rec_type = 254").select("pod_file", "rec_no", "rec_type")
    keyed = X.clicks(spark, sf).select("pod_file", "rec_no", "minute_start", "time_us").join(
        hours.select("pod_file", "minute_start", "m"), ["pod_file", "minute_start"]
    )
    inner = W.amplitude_clicks(spark, sf).join(keyed, ["pod_file", "rec_no"]).select(
        "pod_file", (F.col("rec_no") + F.col("m")).alias("rec_no"), F.lit(100).alias("rec_type"), "time_us",
        F.col("cycles").alias("b4"), ((F.col("ipi") - 1) % 256).alias("b7"), F.col("raw_peak").alias("b11"), "b14", "b15",
    )
    return marks.unionByName(inner, allowMissingColumns=True)


def root(spark: SparkSession, sf: str) -> str:
    """Folder with ``files`` (CP1, CP3, FP1 and FP3 files of the record views) and ``extra`` (files with faults)."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _folders:
        made = new_folder(spark, "files", kept=True)
        files = f"{made}/files"
        _write_files(named(X.records(spark, sf).select("pod_file", "rec_no", "rec_type", "time_us"), "CP"), "CP1", files)
        _write_files(named(X.cp3(spark, sf), "CP"), "CP3", files)
        _write_files(named(fp1_records(spark, sf), "FP"), "FP1", files)
        _write_files(named(X.fp_records(spark, sf), "FP"), "FP3", files)
        _write_extra(f"{made}/extra")
        _folders[key] = made
    return _folders[key]


def folder(spark: SparkSession, sf: str) -> str:
    return f"{root(spark, sf)}/files"


# A pair that is shorter than its header, a train file without raw file, and a cropped pair of a whole one.
SHORT, LONE, CROPPED = "FX8 2024 01 01 POD108 file01", "FX7 2024 01 01 POD107 file01", "FX0 2024 01 01 POD100 file01 PART 1"


def _write_extra(folder: str) -> None:
    system, base = Q.filesystem(folder)
    system.create_dir(base, recursive=True)
    one_record = pd.DataFrame({"rec_type": [254], "time_us": [None], "b4": [0], "b5": [0]})
    for name, kinds in ((SHORT, ("CP1", "CP3")), (LONE, ("CP3",)), (CROPPED, ("CP1", "CP3"))):
        for kind in kinds:
            with system.open_output_stream(f"{base}/{name}.{kind}") as sink:
                sink.write(b"x" * 100 if name == SHORT and kind == "CP3" else b"".join(_file_bytes(kind, [one_record], 1)))


def listed(spark: SparkSession, sf: str) -> DataFrame:
    return X.once(spark, sf, "listed", lambda: I.list_pod_files(spark, folder(spark, sf)))


def to_read(spark: SparkSession, sf: str, kind: str | None = None) -> DataFrame:
    files = listed(spark, sf).withColumn("pod_file", N.stem(F.col("name_ext")))
    return files if kind is None else H.of_kind(files, kind)


FX_FP_NAMED = "SELECT * REPLACE (regexp_replace(pod_file, ' POD1', ' FPOD_2') AS pod_file) FROM fx_fp_records"


def views(body: str, *names: str) -> str:
    """SQL over the streams as files have them: F-POD files under their own names, with the clock of the files."""
    extra = {"fx_fp_named": FX_FP_NAMED}
    own = set(names)
    for name in names:
        own |= set(W._NEEDS[name][1])
    for name, text in W.VIEWS.items():
        if name in own:
            extra[name] = text.replace("fx_fp_records", "fx_fp_named").replace(W.START, FILES_START)
    return with_views(body, "fx_records", "fx_fp_records", extra=extra)


ENCODED = {"CP1": ("cp1_seg", "pod_file", 2), "CP3": ("cp3", "pod_file", 2), "FP1": ("cp1_seg", "regexp_replace(pod_file, ' POD1', ' FPOD_2')", 1), "FP3": ("fp_seg", "pod_file", 1)}


def lengths_sql() -> str:
    parts = [
        f"SELECT concat({name}, '.{kind}') AS name_ext, {LAYOUTS[kind].header_bytes} + (count(*) + {more}) * {LAYOUTS[kind].record_bytes} AS bytes FROM {view} GROUP BY {name}"
        for kind, (view, name, more) in ENCODED.items()
    ]
    return " UNION ALL ".join(parts)


@query("s1_list_files", views(lengths_sql(), "cp3", "cp1_seg", "fp_seg"))
def s1(spark, sf):
    return I.list_pod_files(spark, folder(spark, sf)).select("name_ext", "bytes")


def time_us():
    return R.click_time_us(F.col("b1"), F.col("b2"), F.col("b3"))


@query(
    "s2_read_cp3",
    views(
        """SELECT pod_file, row_number() OVER (PARTITION BY pod_file ORDER BY rec_no) AS rec_no, rec_type,
       CASE WHEN rec_type = 254 THEN b4 END AS b4, b37, time_us FROM cp3""",
        "cp3",
    ),
    gaps=("b4", "b37", "time_us",),
)
def s2(spark, sf):
    """Records up to the end mark; the reader numbers what is in the file."""
    rows = Q.without_errors(Q.read_records(to_read(spark, sf, "CP3"), "CP3", (1, 2, 3, 4, 37)))
    cut = G.segment(rows, stop_at_end=True)
    click = F.col("rec_type") < 254
    return cut.select(
        "pod_file", "rec_no", "rec_type", F.when(~click, F.col("b4")).alias("b4"), F.when(click, F.col("b37")).alias("b37"),
        F.when(click, time_us()).alias("time_us"),
    )


@query(
    "s3_read_cp1",
    views(
        "SELECT pod_file, rec_no + CAST(rec_no > n // 2 AS INT) AS rec_no, rec_type FROM cp1_seg JOIN (SELECT pod_file, count(*) AS n FROM cp1_seg GROUP BY pod_file) c USING (pod_file)",
        "cp1_seg",
    ),
)
def s3(spark, sf):
    return Q.without_errors(Q.read_records(to_read(spark, sf, "CP1"), "CP1"))


@query(
    "s4_read_fp3",
    views(
        """SELECT pod_file, rec_no, CASE WHEN rec_type = 100 THEN CAST((time_us // 5) >> 16 AS INT) ELSE rec_type END AS rec_type,
       CASE WHEN rec_type = 249 THEN b15 END AS b15, CASE WHEN rec_type = 249 THEN b16 END AS b16, time_us FROM fp_seg""",
        "fp_seg",
    ),
    gaps=("b15", "b16", "time_us",),
)
def s4(spark, sf):
    rows = Q.without_errors(Q.read_records(to_read(spark, sf, "FP3"), "FP3", (1, 2, 3, 15, 16)))
    detail = F.col("rec_type") == 249
    return rows.select(
        "pod_file", "rec_no", "rec_type", F.when(detail, F.col("b15")).alias("b15"), F.when(detail, F.col("b16")).alias("b16"),
        F.when(F.col("rec_type") <= 183, time_us()).alias("time_us"),
    )


@query(
    "s5_read_fp1",
    views(
        """SELECT regexp_replace(pod_file, ' POD1', ' FPOD_2') AS pod_file, rec_no, CASE WHEN rec_type < 254 THEN CAST((time_us // 5) >> 16 AS INT) ELSE 254 END AS rec_type,
       time_us FROM cp1_seg""",
        "cp1_seg",
    ),
    gaps=("time_us",),
)
def s5(spark, sf):
    rows = Q.without_errors(Q.read_records(to_read(spark, sf, "FP1"), "FP1", (1, 2, 3)))
    return rows.select("pod_file", "rec_no", "rec_type", F.when(F.col("rec_type") <= 183, time_us()).alias("time_us"))


# The same records through the source, read by name and with filters that it takes over.


def scanned(spark, sf, kind: str, *bytes_wanted: int) -> DataFrame:
    files = to_read(spark, sf, kind).select("pod_file", "path", "bytes")
    return Q.without_errors(DS.scan(files, kind, bytes_wanted, pushdown=True))


@query(
    "s2_scan_cp3_markers",
    views(
        """SELECT pod_file, row_number() OVER (PARTITION BY pod_file ORDER BY rec_no) AS rec_no, rec_type, b4 FROM cp3 QUALIFY rec_type = 254""",
        "cp3",
    ),
)
def s2_scan(spark, sf):
    """Markers of CP3 files; what follows the end mark is told by its record number. Each scan has its own filter."""
    ends = scanned(spark, sf, "CP3").filter("rec_type = 255").groupBy("pod_file").agg(F.min("rec_no").alias("end"))
    marks = scanned(spark, sf, "CP3", 4).filter("rec_type = 254").join(ends, "pod_file", "left").filter("end IS NULL OR rec_no < end")
    return marks.select("pod_file", "rec_no", "rec_type", "b4")


@query(
    "s3_scan_cp1",
    views(
        """SELECT pod_file, rec_no + CAST(rec_no > n // 2 AS INT) AS rec_no, rec_type
FROM cp1_seg JOIN (SELECT pod_file, count(*) AS n FROM cp1_seg GROUP BY pod_file) c USING (pod_file) WHERE rec_no + CAST(rec_no > n // 2 AS INT) BETWEEN 100 AND 50000""",
        "cp1_seg",
    ),
)
def s3_scan(spark, sf):
    """A range of record numbers: other ranges of the files are not opened."""
    return scanned(spark, sf, "CP1").filter("rec_no >= 100 AND rec_no <= 50000").drop("error")


@query(
    "s4_scan_fp3_details",
    views("SELECT pod_file, rec_no, rec_type, b15, b16 FROM fp_seg WHERE rec_type = 249 AND b15 >= 64", "fp_seg"),
)
def s4_scan(spark, sf):
    """Train records by type and byte."""
    return scanned(spark, sf, "FP3", 15, 16).filter("rec_type = 249 AND b15 >= 64")


@query(
    "s5_scan_fp1_types",
    views(
        """SELECT regexp_replace(pod_file, ' POD1', ' FPOD_2') AS pod_file, CASE WHEN rec_type < 254 THEN CAST((time_us // 5) >> 16 AS INT) ELSE 254 END AS rec_type,
       count(*) AS n FROM cp1_seg GROUP BY ALL""",
        "cp1_seg",
    ),
)
def s5_scan(spark, sf):
    return scanned(spark, sf, "FP1").groupBy("pod_file", "rec_type").agg(F.count("*").alias("n"))


@query(
    "s6_header_facts",
    views(
        f"""SELECT DISTINCT pod_file, TIMESTAMP '{FILES_START}' AS start_time, {W.TILT_MIN} AS tilt_min, {W.TILT_MAX} AS tilt_max, {FPGA_VERSION} AS version, TRUE AS has_extended_amps FROM cp3
UNION ALL SELECT DISTINCT pod_file, TIMESTAMP '{FILES_START}', {W.TILT_MIN}, {W.TILT_MAX}, {FPGA_VERSION}, TRUE FROM fp_seg""",
        "cp3", "fp_seg",
    ),
)
def s6(spark, sf):
    both = Q.read_headers(to_read(spark, sf, "CP3"), "CP3").unionByName(Q.read_headers(to_read(spark, sf, "FP3"), "FP3"))
    return both.drop("error")


@query("c1_harmonise_cpod_files", views(W.CP_ROWS_SQL, "cp_minutes", "cp_nall", "cp_train"))
def c1(spark, sf):
    """From CP1 and CP3 bytes to the output rows."""
    return H.harmonise_cpod(to_read(spark, sf), W.BUZZ_US).detections


FP_ROWS_SQL = W.quality_rows_sql("fp_minutes", "fp_train", "t.good = 1")


@query("c2_harmonise_fpod_files", views(FP_ROWS_SQL, "fp_minutes", "fp_train"))
def c2(spark, sf):
    """From FP3 bytes to the output rows."""
    return H.harmonise_fpod(to_read(spark, sf), W.BUZZ_US).detections


TRAINS_SQL = """
SELECT c.pod_file, c.minute_no, c.train_id, c.segment_no, t.q AS quality_class, t.no_of_clicks, c.times, c.icis FROM {train} t JOIN
  (SELECT pod_file, minute_no, train_id, segment_no, string_agg(CAST(time_us AS VARCHAR), ',' ORDER BY rec_no) AS times,
          coalesce(string_agg(CAST(ici AS VARCHAR), ',' ORDER BY rec_no), '') AS icis
   FROM (SELECT *, time_us - lag(time_us) OVER train AS ici, (row_number() OVER train - 1) // 65536 AS segment_no FROM {clicks}
         WINDOW train AS (PARTITION BY pod_file, minute_no, train_id ORDER BY rec_no)) a
   GROUP BY pod_file, minute_no, train_id, segment_no) c USING (pod_file, minute_no, train_id)"""


def train_rows(trains: DataFrame) -> DataFrame:
    return trains.select(
        *G.MINUTE, "train_id", "segment_no", "quality_class", "no_of_clicks",
        F.array_join("time_us", ",").alias("times"), F.array_join("ici_us", ",").alias("icis"),
    )


@query("r4_cpod_trains_from_files", views(TRAINS_SQL.format(train="cp_train", clicks="cp_clicks"), "cp_train"))
def r4_cpod(spark, sf):
    return train_rows(H.cpod_trains(to_read(spark, sf)).rows)


@query("r4_fpod_trains_from_files", views(TRAINS_SQL.format(train="fp_train", clicks="fp_zip"), "fp_train"))
def r4_fpod(spark, sf):
    return train_rows(H.fpod_trains(to_read(spark, sf)).rows)


def c10_files_sql(**how: str) -> str:
    body = W.c10_sql(ipi="rec_no % 300 % 256", extended="TRUE", **how)
    return with_views(
        f"SELECT * REPLACE (regexp_replace(pod_file, ' POD1', ' FPOD_2') AS pod_file) FROM ({body}) f",
        "fx_records", extra={"cp1_seg": W.VIEWS["cp1_seg"]},
    )


@query("c10_filtered_counts_from_files", c10_files_sql())
def c10_files(spark, sf):
    return H.filtered_click_counts(to_read(spark, sf)).rows


@query("c10_filtered_counts_by_duration", c10_files_sql(khz=W.KHZ_BY_DURATION))
def c10_by_duration(spark, sf):
    return H.filtered_click_counts(to_read(spark, sf), by_duration=True).rows


# ---- text sources


@query(
    "s7_read_sheet",
    with_views(
        "SELECT CAST(row_no AS BIGINT) + 1 AS row_no, CASE WHEN RCV_PROJECT = ' ' THEN ' ' ELSE RCV_PROJECT END AS RCV_PROJECT, RECEIVER, ACTIVATION_TIME, DEPLOY_LAT FROM fx_deployments_text",
        "fx_deployments_text",
    ),
)
def s7(spark, sf):
    def build():
        path = new_folder(spark, "sheet")
        rows = X.deployments_text(spark, sf).withColumn("part", F.expr("CASE WHEN row_no < 7 THEN 0 WHEN row_no < 40 THEN 1 ELSE 2 END"))
        spare = [F.lit("x").alias(f"SPARE_{i}") for i in range(40)]
        # Parts of unequal size: what is read first is not what comes first.
        ordered = rows.repartitionByRange(3, "part").sortWithinPartitions("part", "row_no").drop("row_no", "part")
        ordered.select("*", *spare).write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
            "ignoreTrailingWhiteSpace", False
        ).csv(path)
        return I.read_sheet(spark, path)

    sheet = build()
    assert len(sheet.columns) == S.SHEET_COLUMNS + 1
    return sheet.select("row_no", "RCV_PROJECT", "RECEIVER", "ACTIVATION_TIME", "DEPLOY_LAT")


@query("s8_read_vendor_export", with_views("SELECT dt, nall_m FROM fx_vendor", "fx_vendor"), gaps=("nall_m",))
def s8(spark, sf):
    def build():
        path = new_folder(spark, "vendor")
        text = F.date_format("dt", "dd/MM/yyyy HH:mm").alias("ChunkEnd")
        X.vendor(spark, sf).select("nall_m", text).withColumnsRenamed({"nall_m": "Nall_m"}).write.option("header", True).csv(path)
        return I.read_vendor_export(spark, path)

    return build()


# ---- sinks


def _published(spark: SparkSession, name: str, rows: DataFrame, fmt: str = "parquet", **how) -> DataFrame:
    """Written and published below a new folder, and read as its readers find it."""
    out = new_folder(spark, name)
    O.publish(spark, out, {name: rows}, fmt, **how)
    return O.published(spark, out)[name]


@query(
    "k1_write_deployments",
    matches.views(
        """SELECT a.RECEIVER, d.rcv_project AS RCV_PROJECT, CAST(d.activation_day AS TIMESTAMP) AS ACTIVATION_DATE_TIME, d.station_name AS STATION_NAME,
       CAST(d.deploy_day AS TIMESTAMP) AS DEPLOY_DATE_TIME, CAST(d.valid_until_day AS TIMESTAMP) AS VALID_DATA_UNTIL_DATE_TIME, d.deploy_lat AS DEPLOY_LAT, d.deploy_long AS DEPLOY_LONG
FROM annotated a JOIN fx_deployments d USING (row_no) WHERE a.MatchCount > 0""",
        "fx_odd_files",
        annotated=matches.ANNOTATED,
    ),
)
def k1(spark, sf):
    def build():
        rows = M.match_deployments(X.odd_file_list(spark, sf), X.conformed_deployments(spark, sf), matches.odd_index(spark, sf))
        out = O.deployment_rows(rows, S.OUTPUT_ORDER)
        return _published(spark, "deployments", out, "csv")

    return build()


@query("k2_write_detections", views(W.CP_ROWS_SQL, "cp_minutes", "cp_nall", "cp_train"))
def k2(spark, sf):
    """Written by recorder and read again."""
    def build():
        out = H.harmonise_cpod(to_read(spark, sf), W.BUZZ_US).detections
        return _published(spark, "detections", out, by={"detections": "filename"})

    return build()


@query("k3_write_receivers", matches.views(matches.RECEIVERS, "fx_odd_files", annotated=matches.ANNOTATED))
def k3(spark, sf):
    def build():
        out = matches.r1(spark, sf)
        return _published(spark, "receivers", out, "csv")

    return build()


def broken(files: DataFrame, label: str, missing: bool = False, longer: int = 0) -> DataFrame:
    """The same files under another name, gone or listed longer than they are."""
    named = files.withColumn("pod_file", F.concat("pod_file", F.lit(f" {label}")))
    if missing:
        named = named.withColumn("path", F.regexp_replace("path", "([.][CF]P[13])$", " x$1"))
    return named.withColumn("bytes", F.col("bytes") + longer)


def status_kinds(status: DataFrame) -> DataFrame:
    kind = (
        F.when(F.col("error").startswith("FileNotFound"), "not found")
        .when(F.col("error").contains("file ends inside"), "ends early")
        .when(F.col("error").startswith("no CP1"), "no raw file")
    )
    return status.withColumn("error", kind)


def status_sql(view: str, cases: dict[str, tuple[str, str]], name: str = "pod_file") -> str:
    parts = [f"SELECT {name} AS pod_file, 'OK' AS status, CAST(NULL AS VARCHAR) AS error FROM (SELECT DISTINCT pod_file FROM {view}) a"]
    for label, (status, error) in cases.items():
        parts.append(f"SELECT {name} || ' {label}', '{status}', '{error}' FROM (SELECT DISTINCT pod_file FROM {view}) a")
    return " UNION ALL ".join(parts)


CPOD_FAULTS = {
    "lost": ("FAILED", "not found"), "cut": ("FAILED", "ends early"), "alone": ("PARTIAL", "no raw file"),
    "raw cut": ("PARTIAL", "ends early"), "raw lost": ("PARTIAL", "not found"),
}


@query("k4_quarantine", views(status_sql("cp3", CPOD_FAULTS), "cp3"))
def k4(spark, sf):
    """Each file as it is, missing, listed longer than it is, without its raw twin, and with a bad one."""
    files = to_read(spark, sf).filter(F.col("name_ext").rlike("CP[13]$")).select("pod_file", "path", "bytes")
    train, raw = H.of_kind(files, "CP3"), H.of_kind(files, "CP1")
    cases = [
        broken(train, "lost", missing=True), broken(train, "cut", longer=4000), broken(train, "alone"),
        broken(train, "raw cut"), broken(raw, "raw cut", longer=4000), broken(train, "raw lost"), broken(raw, "raw lost", missing=True),
    ]
    for more in cases:
        files = files.unionByName(more)
    return status_kinds(H.harmonise_cpod(files).status)


FPOD_FAULTS = {"lost": ("FAILED", "not found"), "cut": ("FAILED", "ends early")}


@query("k4_quarantine_fpod", views(status_sql("fp_seg", FPOD_FAULTS), "fp_seg"))
def k4_fpod(spark, sf):
    files = to_read(spark, sf, "FP3").select("pod_file", "path", "bytes")
    some = files.unionByName(broken(files, "lost", missing=True)).unionByName(broken(files, "cut", longer=4000))
    return status_kinds(H.harmonise_fpod(some).status)


@query("k4_quarantine_fp1", views(status_sql("cp1_seg", FPOD_FAULTS, "regexp_replace(pod_file, ' POD1', ' FPOD_2')"), "cp1_seg"))
def k4_fp1(spark, sf):
    files = to_read(spark, sf, "FP1").select("pod_file", "path", "bytes")
    some = files.unionByName(broken(files, "lost", missing=True)).unionByName(broken(files, "cut", longer=4000))
    return status_kinds(H.filtered_click_counts(some).status)


@query(
    "k4_rows_of_good_files",
    views(f"SELECT filename, count(*) AS n FROM ({W.CP_ROWS_SQL}) r GROUP BY filename", "cp_minutes", "cp_nall", "cp_train"),
)
def k4_rows(spark, sf):
    """A file that fails in one of its ranges has no rows; the others have all of theirs."""
    files = to_read(spark, sf).filter(F.col("name_ext").rlike("CP[13]$")).select("pod_file", "path", "bytes")
    files = files.unionByName(broken(files, "cut", longer=4000))
    return H.harmonise_cpod(files, W.BUZZ_US).detections.groupBy("filename").agg(F.count("*").alias("n"))


# ---- sheet to checked deployments, and the whole run


def sheet_rows(spark: SparkSession, sf: str) -> DataFrame:
    """A complete sheet with one deployment per recorder and family, split dates, two projects."""
    base = to_read(spark, sf).filter(F.col("name_ext").rlike("P3$")).select(
        F.substring("pod_file", 1, 3).alias("station"), M.receiver_serial(F.regexp_extract("pod_file", "POD_?([0-9]+)", 1)).alias("serial"),
        F.when(F.col("name_ext").endswith("CP3"), "C").otherwise("F").alias("f"),
    ).distinct()
    return _sheet(base)


def _sheet(base: DataFrame, year: str = "2024", until: str = "2") -> DataFrame:
    dates = {"ACTIVATION": (str(int(year) - 1), "12", "31", "8:43"), "DEPLOY": (year, "1", "2", "0:30:00"), "VALID_DATA_UNTIL": (year, "1", until, "7:05:00"),
             "RECOVER": (year, "1", "12", "9:05:00")}
    parts = [F.lit(v).alias(f"{p}_{n}") for p, vs in dates.items() for n, v in zip(("YEAR", "MONTH", "DAY", "TIME"), vs)]
    return base.select(
        F.when(F.col("station") == "FX2", "other").otherwise("harbour").alias("RCV_PROJECT"),
        F.concat(F.col("f"), F.lit("-POD-"), F.col("serial")).alias("RECEIVER"),
        F.concat(F.lit("S"), F.col("station")).alias("STATION_NAME"),
        F.lit("55.68079").alias("DEPLOY_LAT"), F.lit("10.98065").alias("DEPLOY_LONG"), *parts,
    )


def run_sheet_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The sheet and more: the same receivers a year later, receivers without files, and one of a broken file."""
    base = to_read(spark, sf).filter(F.col("name_ext").rlike("CP3$")).select(
        F.substring("pod_file", 1, 3).alias("station"), F.regexp_extract("pod_file", "POD([0-9]+)", 1).alias("serial"), F.lit("C").alias("f")
    )
    broken_one = spark.createDataFrame([("FX8", "108", "C")], base.schema)
    later = _sheet(base, "2025", "9").unionByName(_sheet(base.withColumn("serial", F.concat(F.lit("9"), "serial")), "2024", "6"))
    return sheet_rows(spark, sf).unionByName(later).unionByName(_sheet(broken_one))


def sheet_path(spark: SparkSession, sf: str, rows=sheet_rows) -> str:
    key = (spark.sparkContext.applicationId, f"{sf}#{rows.__name__}")
    if key not in _folders:
        made = new_folder(spark, "sheet", kept=True)
        rows(spark, sf).write.option("header", True).csv(made)
        _folders[key] = made
    return _folders[key]


NUMBERED = """
SELECT DISTINCT substr(pod_file, 1, 3) AS station, regexp_extract(pod_file, 'POD_?([0-9]+)', 1) AS serial, regexp_extract(pod_file, ' (F?)POD', 1) = 'F' AS f
FROM (SELECT pod_file FROM cp3 UNION ALL SELECT pod_file FROM fp_seg) p WHERE pod_file NOT LIKE 'FX2%'"""


@query(
    "c7_prepare_deployments",
    views(
        f"""SELECT 'harbour' AS RCV_PROJECT, CASE WHEN f THEN 'F' ELSE 'C' END || '-POD-' || serial AS RECEIVER, 'S' || station AS STATION_NAME,
       TIMESTAMP '2023-12-31 08:43:00' AS ACTIVATION_DATE_TIME, TIMESTAMP '2024-01-02 00:30:00' AS DEPLOY_DATE_TIME, 55.68079::DOUBLE AS DEPLOY_LAT,
       TIMESTAMP '2024-01-12 09:05:00' AS RECOVER_DATE_TIME, 'Na' AS COMMENTS FROM ({NUMBERED}) n""",
        "cp3", "fp_seg",
    ),
)
def c7(spark, sf):
    done = P.prepare_deployments(I.read_sheet(spark, sheet_path(spark, sf)), project="harbour")
    return done.select(
        "RCV_PROJECT", "RECEIVER", "STATION_NAME", "ACTIVATION_DATE_TIME", "DEPLOY_DATE_TIME", "DEPLOY_LAT", "RECOVER_DATE_TIME", "COMMENTS"
    )


# A sheet with one deployment a customer and five projects; two of them have wrong dates and coordinates.
VARIED = """
SELECT *, f AND row_no % 17 = 0 AS early, f AND row_no % 13 = 0 AS ended, f AND row_no % 9 = 0 AS recovered, f AND row_no % 11 = 0 AS north, f AND row_no % 14 = 0 AS word
FROM (SELECT row_number() OVER (ORDER BY row_no) AS place, row_no, rcv_project IN ('BUILDING', 'MACHINERY') AS f, rcv_project, receiver, station_name, deploy_lat, deploy_long,
             activation_day, deploy_day, valid_until_day FROM fx_deployments) d"""
VARIED_DATES = """
SELECT *, CASE WHEN early THEN activation_day - INTERVAL 40 YEAR ELSE activation_day END + INTERVAL 8 HOUR AS a, deploy_day + INTERVAL 30 MINUTE AS d,
       CASE WHEN ended THEN activation_day - INTERVAL 1 DAY ELSE valid_until_day END + INTERVAL 7 HOUR AS v,
       CASE WHEN recovered THEN activation_day - INTERVAL 3 DAY ELSE deploy_day + INTERVAL 200 DAY END + INTERVAL 9 HOUR AS r FROM varied"""
VARIED_FAULTS = f"""
SELECT rcv_project, place, 'V3' AS check_id, c AS column_name, printf('Row %d: %s is earlier than minDate.', place, c) AS message
FROM (SELECT rcv_project, place, unnest([struct_pack(c := 'ACTIVATION_DATE_TIME', t := a), struct_pack(c := 'DEPLOY_DATE_TIME', t := CAST(d AS TIMESTAMP)),
      struct_pack(c := 'VALID_DATA_UNTIL_DATE_TIME', t := v), struct_pack(c := 'RECOVER_DATE_TIME', t := r)], recursive := true) FROM dates) u WHERE t < TIMESTAMP '{S.MIN_DATE}'
UNION ALL SELECT rcv_project, place, 'V4', c, m FROM (
  SELECT rcv_project, place, 'DEPLOY_DATE_TIME' AS c, 'Deployment date must be before recovery date.' AS m FROM dates WHERE d > r
  UNION ALL SELECT rcv_project, place, 'ACTIVATION_DATE_TIME', 'Activation date must be before recovery date.' FROM dates WHERE a > r
  UNION ALL SELECT rcv_project, place, 'ACTIVATION_DATE_TIME', 'Activation date must be before valid until date.' FROM dates WHERE a > v
  UNION ALL SELECT rcv_project, place, 'DEPLOY_DATE_TIME', 'Deployment date must be before valid until date.' FROM dates WHERE d > v) o
UNION ALL SELECT rcv_project, place, 'V5', 'DEPLOY_LAT', printf('Row %d: - Invalid %s.', place, CASE WHEN north AND word THEN 'latitude and longitude' WHEN north THEN 'latitude' ELSE 'longitude' END)
FROM dates WHERE north OR word"""


def varied_sheet(spark: SparkSession, sf: str) -> DataFrame:
    """The rows of VARIED_DATES as a sheet has them: everything text, dates in four cells."""
    base, row = X.deployments(spark, sf), F.col("row_no")
    faulty = F.col("rcv_project").isin("BUILDING", "MACHINERY")
    every = lambda n: faulty & (row % n == 0)
    first = F.col("activation_day")
    dates = {
        "ACTIVATION": (F.when(every(17), F.add_months(first, -480)).otherwise(first), "8:00"),
        "DEPLOY": (F.col("deploy_day"), "0:30:00"),
        "VALID_DATA_UNTIL": (F.when(every(13), F.date_sub(first, 1)).otherwise(F.col("valid_until_day")), "07:00"),
        "RECOVER": (F.when(every(9), F.date_sub(first, 3)).otherwise(F.date_add("deploy_day", 200)), "9:00:00"),
    }
    parts = []
    for name, (day, time) in dates.items():
        units = zip(("YEAR", "MONTH", "DAY"), (F.year, F.month, F.dayofmonth), strict=True)
        parts += [unit(day).cast("string").alias(f"{name}_{part}") for part, unit in units] + [F.lit(time).alias(f"{name}_TIME")]
    return base.select(
        "row_no", F.col("rcv_project").alias("RCV_PROJECT"), F.col("receiver").alias("RECEIVER"), F.col("station_name").alias("STATION_NAME"),
        F.when(every(11), "95.5").otherwise(X.text(F.col("deploy_lat") / 2)).alias("DEPLOY_LAT"),
        F.when(every(14), "west").otherwise(X.text(F.col("deploy_long") / 2)).alias("DEPLOY_LONG"), *parts,
    )


@query(
    "c7_prepare_each_project",
    with_views(
        f"""SELECT rcv_project AS project, place AS row_no, check_id, column_name, message FROM ({VARIED_FAULTS}) f
UNION ALL SELECT rcv_project, place, 'OK', receiver, strftime(a, '%Y-%m-%d %H:%M') || ' ' || strftime(r, '%Y-%m-%d %H:%M') FROM dates WHERE NOT f""",
        "fx_deployments",
        extra={"varied": VARIED, "dates": VARIED_DATES},
    ),
)
def c7_projects(spark, sf):
    """The strict preparation of each project: its checked rows, or the table of everything that is wrong with them."""
    path = new_folder(spark, "varied-sheet")
    rows = varied_sheet(spark, sf)
    rows.repartitionByRange("row_no").sortWithinPartitions("row_no").drop("row_no").write.option("header", True).csv(path)
    sheet = I.read_sheet(spark, path)
    tables = []
    for name in [r.project for r in P.projects(sheet).select("project").collect()]:  # the choices a user has
        try:
            done = P.prepare_deployments(sheet, name)
            day = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm")
            text = F.concat(day("ACTIVATION_DATE_TIME"), F.lit(" "), day("RECOVER_DATE_TIME"))
            found = done.select("row_no", F.lit("OK").alias("check_id"), F.col("RECEIVER").alias("column_name"), text.alias("message"))
        except P.MetadataError as error:
            found = spark.read.parquet(error.path).select("row_no", "check_id", "column_name", "message")
        tables.append(found.select(F.lit(name).alias("project"), "*"))
    every = tables[0]
    for table in tables[1:]:
        every = every.unionByName(table)
    return every


RUN_SQL = f"""
SELECT * REPLACE (concat('S', substr(filename, 1, 3), ' 2024 01 02 POD', regexp_extract(filename, 'POD_?([0-9]+)', 1)) AS filename), filename AS PODfile
FROM (SELECT * FROM ({W.CP_ROWS_SQL}) a UNION ALL BY NAME SELECT * FROM ({FP_ROWS_SQL}) b) u
WHERE filename NOT LIKE 'FX2%' AND DETECTION_DATE_TIME BETWEEN TIMESTAMP '2024-01-02 00:30:00' AND TIMESTAMP '2024-01-02 07:05:00'"""


def whole_run(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Files and sheet in, all output tables written and read again."""
    sheet = sheet_path(spark, sf, run_sheet_rows)
    return H.run(spark, root(spark, sf), sheet, new_folder(spark, "run", kept=True), project="harbour", buzz_us=W.BUZZ_US)


@query("r3_harmonise_run", views(RUN_SQL, "cp_minutes", "cp_nall", "cp_train", "fp_minutes", "fp_train"))
def r3(spark, sf):
    return whole_run(spark, sf)["detections"]


# Files of the run that belong to a deployment of the sheet.
RUN_FILES = """
SELECT pod_file, concat('S', substr(pod_file, 1, 3)) AS station, regexp_extract(pod_file, 'POD_?([0-9]+)', 1) AS serial, f
FROM (SELECT DISTINCT pod_file, FALSE AS f FROM cp3 UNION ALL SELECT DISTINCT pod_file, TRUE FROM fp_seg) p WHERE pod_file NOT LIKE 'FX2%'"""
RUN_NAMES = f"""
SELECT *, concat(station, ' 2024 01 02 POD', serial) AS id FROM ({RUN_FILES}
UNION ALL SELECT '{SHORT}', 'SFX8', '108', FALSE) u"""


@query(
    "r3_run_deployments",
    views(
        f"""SELECT serial AS RECEIVER, station AS STATION_NAME, 'harbour' AS RCV_PROJECT, TIMESTAMP '2024-01-02 00:30:00' AS DEPLOY_DATE_TIME,
       TIMESTAMP '2024-01-02 07:05:00' AS VALID_DATA_UNTIL_DATE_TIME FROM ({RUN_NAMES}) n""",
        "cp3", "fp_seg",
    ),
)
def r3_deployments(spark, sf):
    """Of the sheet only the rows that a file belongs to."""
    done = whole_run(spark, sf)["deployments"]
    return done.select("RECEIVER", "STATION_NAME", "RCV_PROJECT", "DEPLOY_DATE_TIME", "VALID_DATA_UNTIL_DATE_TIME")


@query(
    "r3_run_matched_files",
    views(
        f"SELECT id AS DeploymentID, concat(pod_file, CASE WHEN f THEN '.FP3' ELSE '.CP3' END) AS FileName FROM ({RUN_NAMES}) n", "cp3", "fp_seg"
    ),
)
def r3_matched(spark, sf):
    return whole_run(spark, sf)["matched_files"].select("DeploymentID", "FileName")


@query(
    "r3_run_receivers",
    views(
        f"""SELECT 'CHELONIA' AS RCV_MANUFACTURER, serial AS RECEIVER_ID_SERIAL_NUMBER, CASE WHEN f THEN 'F-POD' ELSE 'C-POD' END AS RECEIVER_MODEL,
       'Active' AS RCV_STATUS FROM ({RUN_NAMES}) n""",
        "cp3", "fp_seg",
    ),
)
def r3_receivers(spark, sf):
    return whole_run(spark, sf)["receivers"]


OVERVIEW_NAMES = f"""SELECT pod_file AS Filename, TRUE AS known, CAST(NULL AS TIMESTAMP) AS dt FROM ({RUN_NAMES}) a
UNION ALL SELECT DISTINCT pod_file, FALSE, CAST(NULL AS TIMESTAMP) FROM cp3 WHERE pod_file LIKE 'FX2%'
UNION ALL SELECT DISTINCT pod_file, FALSE, CAST(NULL AS TIMESTAMP) FROM fp_seg WHERE pod_file LIKE 'FX2%'
UNION ALL SELECT PODfile, NULL, DETECTION_DATE_TIME FROM ({RUN_SQL}) r"""


@query(
    "r3_run_overview",
    views(
        f"""SELECT Filename, CASE WHEN known THEN 'Yes' ELSE 'No' END AS MetadataMatch,
       CASE WHEN known THEN '0 days, 6 hours, 35 minutes' ELSE 'N/A' END AS MetadataDeployment,
       CASE WHEN t IS NULL THEN 'N/A' ELSE printf('%d days, %d hours, %d minutes', t // 86400, (t % 86400) // 3600, (t % 3600) // 60) END AS DetectionSpan,
       CASE WHEN NOT known THEN 'NOT ATTEMPTED' WHEN Filename = '{SHORT}' THEN 'FAILED' ELSE 'OK' END AS Status
FROM (SELECT Filename, bool_or(known) AS known, date_diff('second', min(dt), max(dt)) AS t FROM ({OVERVIEW_NAMES}) u GROUP BY Filename) g""",
        "cp_minutes", "cp_nall", "cp_train", "fp_minutes", "fp_train", "cp3", "fp_seg",
    ),
)
def r3_overview(spark, sf):
    return whole_run(spark, sf)["overview"].drop("sel_no")


@query("r3_run_bad_files", f"SELECT '{SHORT}' AS pod_file, 'FAILED' AS status, 'CP' AS family FROM region WHERE r_regionkey = 0")
def r3_bad(spark, sf):
    return whole_run(spark, sf)["bad_files"].select("pod_file", "status", "family")


@query(
    "r3_run_rejected_files",
    f"SELECT '{CROPPED}' || kind AS name_ext, 'WORSE_VARIANT' AS reason FROM (SELECT unnest(['.CP1', '.CP3']) AS kind FROM region WHERE r_regionkey = 0) k",
)
def r3_rejected(spark, sf):
    return whole_run(spark, sf)["rejected_files"].select("name_ext", "reason")


@query("r3_run_file_problems", f"SELECT '{LONE}.CP3' AS name_ext FROM region WHERE r_regionkey = 0")
def r3_problems(spark, sf):
    return whole_run(spark, sf)["file_problems"].select(N.base_name(F.col("path")).alias("name_ext"))

"""From detector files and a deployment sheet to the output tables."""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickloom import layout as L, spec as S
from clickloom.functions import filenames as N
from clickloom.operators import (
    deployments as P,
    detections as D,
    files as C,
    matching as M,
    noise as Z,
    ranges as V,
    segment as G,
    trains as T,
)
from clickloom.plans import outputs as O
from clickloom.session import at_once, scratch, step
from clickloom.sources import files as I, records as Q, trains as J

# Bytes of a C-POD click in the array form.
CLICK_BYTES = {"cycles": 4, "bandwidth": 5, "frequency": 6, "end_frequency": 7, "nix": 8}


@dataclass(frozen=True)
class Harmonised:
    """Detection rows and the status of each train file (pod_file, status, error)."""

    detections: DataFrame
    status: DataFrame


@dataclass(frozen=True)
class Read:
    """Rows of another kind (click trains, click counts) and the status of each file they come from."""

    rows: DataFrame
    status: DataFrame


def of_kind(files: DataFrame, kind: str) -> DataFrame:
    return files.filter(N.extension(F.col("path")) == kind)


NO_RAW_FILE = "no CP1 file: click totals and tail minute are missing"
# Files whose facts may be sent to every task: about a kilobyte each, for 10 GB of records.
MAX_BROADCAST = 20_000


def _status(facts: DataFrame) -> DataFrame:
    """OK, PARTIAL (no readable raw file beside it) or FAILED for each train file."""
    missing = F.lit(None).cast("string")
    if "has_raw" in facts.columns:
        missing = F.when(F.col("has_raw").isNull(), NO_RAW_FILE).otherwise(F.col("raw_error"))
    return facts.filter("is_train").select(
        "pod_file",
        F.when(F.col("error").isNotNull(), "FAILED").when(missing.isNotNull(), "PARTIAL").otherwise("OK").alias("status"),
        F.coalesce("error", missing).alias("error"),
    )


def _few(facts: DataFrame) -> DataFrame:
    """Sent to every task if the files are counted to be few; else joined by shuffle."""
    return F.broadcast(facts) if facts.count() <= MAX_BROADCAST else facts


@dataclass(frozen=True)
class _Minutes:
    """What one read of train files gives: parts by minute, minute rows, and the facts of each file."""

    parts: DataFrame
    rows: DataFrame
    facts: DataFrame


def _cpod_minutes(files: DataFrame, read) -> _Minutes:
    """Minutes of C-POD files; ``read`` makes the written parts of the CP3 files."""
    spark = files.sparkSession
    three, one = of_kind(files, "CP3"), of_kind(files, "CP1")
    found, counts, headers = at_once(
        lambda: step(spark, "cp3-parts", lambda: read(three)),
        lambda: step(spark, "cp1-counts", lambda: J.read_click_counts(one)),
        lambda: step(spark, "cp3-headers", lambda: Q.read_headers(three, "CP3")),
    )
    known = headers.select("pod_file", "start_time", "tilt_min", "tilt_max", "error")
    facts = step(spark, "cp3-files", lambda: V.file_facts(Q.file_ends(three, "CP3"), found, known, one, counts))
    few = _few(facts)
    minutes = V.in_minutes(found, few, closed=True)
    per_file = V.good_files(few).select("pod_file", "n_markers", "has_tail", "start_time", "tilt_min", "tilt_max")
    rows = G.with_minute_on(G.with_clock(G.cpod_minute_rows(V.marks(minutes), per_file)))
    return _Minutes(minutes, G.with_nall(rows, V.click_totals(counts, few)), facts)


def _fpod_minutes(three: DataFrame, read) -> _Minutes:
    spark = three.sparkSession
    found, headers = at_once(
        lambda: step(spark, "fp3-parts", lambda: read(three)),
        lambda: step(spark, "fp3-headers", lambda: Q.read_headers(three, "FP3")),
    )
    known = headers.select("pod_file", "start_time", "error")
    facts = step(spark, "fp3-files", lambda: V.file_facts(Q.file_ends(three, "FP3"), found, known))
    few = _few(facts)
    minutes = V.in_minutes(found, few)
    rows = G.fpod_minute_rows(V.marks(minutes)).join(V.good_files(few).select("pod_file", "start_time"), "pod_file")
    return _Minutes(minutes, G.with_clock(rows), facts)


def _trains(minutes: _Minutes, family: str, values: dict[str, str]) -> DataFrame:
    whole, shared = V.click_rows(minutes.parts, family, values)
    arrays = T.with_class(V.click_arrays(whole, shared, ["time_us", *values]), family)
    return arrays.join(minutes.rows.select(*G.MINUTE, "minute_start"), G.MINUTE).drop("class_byte")


def _single(rows: DataFrame) -> DataFrame:
    """Read rows as they are, in the form of parts."""
    return rows.withColumn("single", F.when(F.col("what") != J.CLICK, F.col("rec_no")))


def cpod_trains(files: DataFrame) -> Read:
    """Click trains of C-POD files with their clicks as arrays, and the status of the files."""
    minutes = _cpod_minutes(files, lambda three: _single(J.read_trains(three, "CP3", tuple(CLICK_BYTES.values()))))
    trains = _trains(minutes, "CP", {name: f"v{b}" for name, b in CLICK_BYTES.items()})
    return Read(trains, _status(minutes.facts))


def harmonise_cpod(files: DataFrame, buzz_us: int = L.BUZZ_US) -> Harmonised:
    """Detection rows of C-POD files. ``files`` has pod_file, path, bytes; a CP1 and CP3 pair shares its own pod_file.

    Without a readable CP1 twin the click total is NULL and there is no tail minute; a CP3 file that cannot be
    read is left out. Both are reported. Rows and status come from the same written read.
    """
    minutes = _cpod_minutes(files, lambda three: V.parts(J.read_trains(three, "CP3")))
    counts = T.minute_counts(T.with_class(V.train_facts(minutes.parts, "CP"), "CP"), buzz_us=buzz_us)
    return Harmonised(D.output_rows(D.fill_empty_minutes(minutes.rows, counts)), _status(minutes.facts))


def fpod_trains(files: DataFrame) -> Read:
    """Click trains of F-POD files with their click times as arrays, and the status of the files."""
    minutes = _fpod_minutes(of_kind(files, "FP3"), lambda found: _single(J.read_trains(found, "FP3")))
    return Read(_trains(minutes, "FP", {}), _status(minutes.facts))


def harmonise_fpod(files: DataFrame, buzz_us: int = L.BUZZ_US) -> Harmonised:
    """Detection rows of F-POD files. FP1 files are not read."""
    minutes = _fpod_minutes(of_kind(files, "FP3"), lambda found: V.parts(J.read_trains(found, "FP3")))
    facts = T.with_class(V.train_facts(minutes.parts, "FP"), "FP")
    counts = T.minute_counts(facts, need_species_good=True, buzz_us=buzz_us)
    return Harmonised(D.output_rows(D.fill_empty_minutes(minutes.rows, counts)), _status(minutes.facts))


def filtered_click_counts(files: DataFrame, by_duration: bool = False) -> Read:
    """Clicks per minute of FP1 files within the amplitude and frequency limits: one pass, no shuffle of records."""
    spark = files.sparkSession
    one = of_kind(files, "FP1")
    headers = step(spark, "fp1-headers", lambda: Q.read_headers(one, "FP1"))
    known = headers.filter(F.col("error").isNull()).select("pod_file", "has_extended_amps")
    rows = Q.read_records(one.join(known, "pod_file"), "FP1", (4, 7, 11, 14, 15), carry=("has_extended_amps",), markers=True)
    counts = step(spark, "fp1-counts", lambda: Z.counts_by_split(rows, by_duration))
    bad = step(spark, "fp1-failures", lambda: Q.failures(counts, headers))
    whole = counts.filter(F.col("error").isNull()).drop("error").join(bad, "pod_file", "left_anti")
    failed = F.col("error").isNotNull()
    status = one.select("pod_file").join(bad, "pod_file", "left").withColumn("status", F.when(failed, "FAILED").otherwise("OK"))
    return Read(Z.counts_by_minute(whole), status.select("pod_file", "status", "error"))


def harmonise(files: DataFrame, buzz_us: int = L.BUZZ_US) -> Harmonised:
    """Detection rows of all files, both families; rows and status have ``family`` (CP or FP)."""
    c, f = at_once(lambda: harmonise_cpod(files, buzz_us), lambda: harmonise_fpod(files, buzz_us))
    tagged = [[t.withColumn("family", F.lit(k)) for t in (h.detections, h.status)] for h, k in ((c, "CP"), (f, "FP"))]
    return Harmonised(*[one.unionByName(two) for one, two in zip(*tagged)])


def files_to_read(selected: DataFrame, files: DataFrame) -> DataFrame:
    """Train files of a process list and the raw files beside them: pod_file, path, bytes."""
    beside, family = F.lower(N.variant_stem(F.col("path"))), N.family(F.col("path"))
    wanted = selected.select(
        N.stem(F.col("name_ext")).alias("pod_file"), beside.alias("_beside"), family.alias("_family")
    ).distinct()
    found = files.select("path", "bytes", beside.alias("_beside"), family.alias("_family"))
    return found.join(wanted, ["_beside", "_family"]).drop("_beside", "_family")


def run(
    spark: SparkSession,
    root: str,
    sheet_path: str,
    out: str,
    project: str | None = None,
    mode: str = "serial",
    buzz_us: int = L.BUZZ_US,
    fmt: str = "parquet",
) -> dict[str, DataFrame]:
    """Read everything under ``root``, match it to the sheet and write all output tables under ``out``.

    Returns the tables as written; :func:`clickloom.plans.outputs.published` finds them later. They appear all at once,
    and until then the set of an earlier run stays. Intermediate tables of the run lie in one folder, which is removed at the
    end. If the run dies, the next start with the same files, sheet and parameters goes on with the steps it finished.
    """
    key = input_key(spark, root, sheet_path, project, mode, buzz_us)
    with scratch(spark, "run", key):
        return _run(spark, root, sheet_path, out, project, mode, buzz_us, fmt)


def input_key(spark: SparkSession, root: str, sheet_path: str, *parameters) -> str:
    """Digest of what a run depends on: path, size and time of every file and of the sheet, and the parameters."""
    listed = I.detector_files(spark, root).select("path", "length", "modificationTime", F.lit("file").alias("what"))
    sheet = spark.read.format("binaryFile").load(sheet_path)
    listed = listed.unionByName(sheet.select("path", "length", "modificationTime", F.lit("sheet").alias("what")))
    sums = [F.sum(F.xxhash64("path", "length", "modificationTime", "what", F.lit(i)).cast("decimal(20,0)")) for i in (1, 2)]
    found = listed.agg(F.count("*").alias("n"), *sums).first()
    facts = [root, sheet_path, *map(str, found), *map(repr, parameters), S.OUTPUT_ORDER]
    return hashlib.sha256(json.dumps(facts).encode()).hexdigest()[:32]


def _run(spark, root, sheet_path, out, project, mode, buzz_us, fmt) -> dict[str, DataFrame]:
    files = step(spark, "files", lambda: I.list_pod_files(spark, root))
    kept, rejected = C.dedup_files(files)
    kept = step(spark, "kept-files", lambda kept=kept: kept)
    sheet = step(spark, "deployments", lambda: P.prepare_deployments(I.read_sheet(spark, sheet_path), project))
    index = M.match_index(kept, sheet, mode)
    index = M.MatchIndex(*at_once(lambda: step(spark, "index", lambda: index.files), lambda: step(spark, "covered", lambda: index.covered)))
    rows = step(spark, "matched", lambda: M.match_deployments(kept, sheet, index))
    matched = rows.filter(F.col("RowType") == "metadata")
    train = M.train_files(kept)
    todo = step(spark, "process-list", lambda: M.process_list(train, kept, index, matched))
    done = harmonise(step(spark, "files-to-read", lambda: files_to_read(todo, kept)), buzz_us)
    name = F.col("name_ext")
    labels = todo.select(
        N.stem(name).alias("pod_file"), N.family(name).alias("family"), "deployment_id", "deploy", "valid_until"
    ).distinct()
    detections = step(spark, "detections", lambda: D.clip(D.relabel(done.detections, labels)))
    spans = M.detection_spans(detections, ("PODfile", "family"))
    status = step(spark, "status", lambda: done.status)
    options = {c: values for c, values in S.OPTIONS.items() if c in sheet.columns}
    tables = {
        # Dates, order and coordinates stop a run; values outside the options only lead to rows here.
        "violations": P.violation_rows(sheet, P.option_cases(options)),
        "deployments": O.deployment_rows(rows, S.OUTPUT_ORDER),
        "matched_files": M.matched_files(index, matched),
        "receivers": M.receivers(matched),
        "overview": M.file_overview(train, index, matched, spans, status),
        "bad_files": status.filter("status <> 'OK'"),
        "rejected_files": rejected,
        "file_problems": C.pair_problems(files),
        "detections": detections.select(*D.OUTPUT_COLUMNS, "PODfile"),
    }
    return O.publish(spark, out, tables, fmt, by={"detections": "filename"})

"""Files to deployments, and the tables built from the matches.

A file names a recorder serial and a day; a deployment covers an interval of days of a serial. The interval is cut into
blocks of 1, 2, 4, ... days that start at multiples of their length, at most two of each length, and a day lies in one block
of each length. So files and deployments meet in equal (serial, level, block), however long a deployment lasts, and each
pair meets once. Counts and types are added up for each block and not for each day, the lowest row number is kept for
each block, and busy serials are spread over their blocks. Only :func:`match_pairs` lists pairs, because there they
are the result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from clickloom.functions import filenames as N, text as T
from clickloom.operators.ordering import first_row, number_in_groups

LIST_FILES = 10_000
# Receiver numbers that may be sent to every task: a few MB.
MAX_BROADCAST = 100_000
# Longest blocks: 2^14 days, 45 years. A longer interval has several of them.
TOP_LEVEL = 14

MANUFACTURER = "CHELONIA"
STATUS = "Active"


def receiver_serial(receiver: Column) -> Column:
    """First digit run; NULL without digits."""
    return F.nullif(F.regexp_extract(receiver, r"(\d+)", 1), F.lit(""))


def deployment_id(station: Column, deploy: Column, receiver: Column) -> Column:
    """``<station> <yyyy mm dd> POD<serial>``; NULL without deploy date or serial."""
    return F.concat(
        station, F.lit(" "), F.date_format(deploy, "yyyy MM dd"), F.lit(" POD"), receiver_serial(receiver)
    )


def train_files(files: DataFrame) -> DataFrame:
    return files.filter(N.is_train_file(F.col("name_ext")))


def in_range(day: Column, activation: Column, deploy: Column, end: Column, inclusive: bool = False) -> Column:
    """File day against a deployment, all at day level.

    A file of the day that is both activation and deployment day matches only with ``inclusive``.
    """
    if inclusive:
        return (day >= F.least(activation, deploy)) & (day < end)
    before = (day >= activation) & (day < deploy)
    after = (day >= deploy) & (day > activation)
    return (before | after) & (day < end)


def _serial_rows(files: DataFrame, mode: str) -> DataFrame:
    core = N.stem(F.col("name_ext"))
    if mode == "serial":
        return files.withColumn("serial", N.serial(core)).filter(F.col("serial").isNotNull())
    # A receiver number matches where it starts a digit run after POD or FPOD_.
    runs = F.flatten(
        F.array(
            F.regexp_extract_all(core, F.lit(r"POD(\d+)"), F.lit(1)),
            F.regexp_extract_all(core, F.lit(r"FPOD_(\d+)"), F.lit(1)),
        )
    )
    starts = F.flatten(
        F.transform(runs, lambda r: F.transform(F.sequence(F.lit(1), F.length(r)), lambda n: F.substr(r, F.lit(1), n)))
    )
    return files.withColumn("serial", F.explode(F.array_distinct(starts)))


def covered_days(activation: Column, deploy: Column, end: Column, inclusive: bool = False) -> tuple[Column, Column]:
    """First day and the day after the last of what :func:`in_range` accepts, as day numbers."""
    first = F.unix_date(F.least(activation, deploy))
    if not inclusive:  # the activation day itself counts only if it lies before the deployment
        first = F.unix_date(activation) + F.when(activation < deploy, 0).otherwise(1)
    return first, F.unix_date(end)


def day_blocks(first: Column, until: Column) -> Column:
    """Blocks (level, block) that together hold the days from ``first`` up to ``until``, none twice.

    Level by level, a block at either end that does not fill a block of the next level is taken.
    """
    pieces = []
    for level in range(TOP_LEVEL):
        low = F.shiftright(first + F.lit(2**level - 1), level)
        high = F.shiftright(until, level)
        odd = lambda n: F.pmod(n, F.lit(2)) == 1
        one = lambda n, level=level: F.struct(F.lit(level).alias("level"), n.cast("long").alias("block"))
        pieces.append(F.when((low < high) & odd(low), one(low)))
        pieces.append(F.when((low < high) & odd(high), one(high - 1)))
    low, high = F.shiftright(first + F.lit(2**TOP_LEVEL - 1), TOP_LEVEL), F.shiftright(until, TOP_LEVEL) - 1
    tops = F.when(low <= high, F.transform(F.sequence(low, high), lambda n: F.struct(F.lit(TOP_LEVEL).alias("level"), n.cast("long").alias("block"))))
    none = F.array().cast("array<struct<level: int, block: bigint>>")
    return F.concat(F.array_compact(F.array(*pieces)), F.coalesce(tops, none))


def blocks_of_day(day: Column) -> Column:
    """The block (level, block) of each length that a day lies in."""
    number = F.unix_date(day)
    levels = range(TOP_LEVEL + 1)
    return F.array(*(F.struct(F.lit(k).alias("level"), F.shiftright(number, k).cast("long").alias("block")) for k in levels))


BLOCK = ["serial", "level", "block"]


@dataclass(frozen=True)
class MatchIndex:
    """Both sides of the match.

    ``files``: sel_no, name_ext, serial, day. ``covered``: row_no, serial, level, block.
    """

    files: DataFrame
    covered: DataFrame


def match_index(
    files: DataFrame, deployments: DataFrame, mode: str = "serial", inclusive: bool = False
) -> MatchIndex:
    """Index train files and deployments. ``mode="contains"`` accepts a receiver number that starts a longer serial."""
    if mode not in ("serial", "contains"):
        raise ValueError(f"unknown mode {mode!r}")
    dated = train_files(files).withColumn("day", N.strict_day(F.col("name_ext"))).filter(F.col("day").isNotNull())
    named = _serial_rows(dated, mode).select("sel_no", "name_ext", "serial", "day")
    spans = deployments.select(
        "row_no",
        receiver_serial(F.col("RECEIVER")).alias("serial"),
        F.to_date("ACTIVATION_DATE_TIME").alias("activation"),
        F.to_date("DEPLOY_DATE_TIME").alias("deploy"),
        F.to_date("VALID_DATA_UNTIL_DATE_TIME").alias("end"),
    ).filter("serial IS NOT NULL AND activation IS NOT NULL AND deploy IS NOT NULL AND end IS NOT NULL")
    if mode == "contains":
        # Most starts of a serial belong to no receiver: they go before anything is shuffled.
        serials = spans.select("serial").distinct()
        if serials.limit(MAX_BROADCAST + 1).count() <= MAX_BROADCAST:
            serials = F.broadcast(serials)
        named = named.join(serials, "serial", "left_semi")
    first, until = covered_days(F.col("activation"), F.col("deploy"), F.col("end"), inclusive)
    blocks = F.explode(day_blocks(F.col("first"), F.col("until"))).alias("at")
    covered = spans.select("row_no", "serial", first.alias("first"), until.alias("until")).filter("first < until")
    return MatchIndex(named, covered.select("row_no", "serial", blocks).select("row_no", "serial", "at.*"))


def _meet(one: DataFrame, other: DataFrame, on: list[str]) -> DataFrame:
    """Joined by merging. Blocks and names are made by expressions, so estimates see the compressed tables that they come
    from, and both sides would be broadcast at many times the size that is allowed."""
    return one.join(other.hint("merge"), on)


def _in_blocks(days: DataFrame) -> DataFrame:
    """Rows with serial and day once for each block of the day."""
    kept = [c for c in days.columns if c != "at"]
    return days.select(*kept, F.explode(blocks_of_day(F.col("day"))).alias("at")).select(*kept, "at.*")


def match_pairs(index: MatchIndex) -> DataFrame:
    """Pairs (row_no, sel_no, name_ext) of deployments and train files."""
    days = _in_blocks(index.files.select("serial", "day").distinct())
    rows = _meet(days, index.covered, BLOCK).select("serial", "day", "row_no")
    return _meet(index.files, rows, ["serial", "day"]).select("row_no", "sel_no", "name_ext")


def matched_files(index: MatchIndex, deployments: DataFrame) -> DataFrame:
    """Which file belongs to which deployment: DeploymentID, FileName, and ``row_no`` and ``sel_no`` for their order."""
    ids = deployments.select("row_no", "DeploymentID")
    return _meet(match_pairs(index), ids, ["row_no"]).select("DeploymentID", F.col("name_ext").alias("FileName"), "row_no", "sel_no")


def annotate(deployments: DataFrame, index: MatchIndex) -> DataFrame:
    """Deployments with MatchCount, PodType (of the last file), RowType and DeploymentID."""
    per_day = index.files.groupBy("serial", "day").agg(
        F.count("*").alias("_n"),
        F.max_by(N.pod_type(F.col("name_ext")), "sel_no").alias("_type"),
        F.max("sel_no").alias("_last"),
    )
    per_block = _in_blocks(per_day).groupBy(*BLOCK).agg(
        F.sum("_n").alias("_n"), F.max_by("_type", "_last").alias("_type"), F.max("_last").alias("_last")
    )
    found = (
        _meet(index.covered, per_block, BLOCK)
        .groupBy("row_no")
        .agg(F.sum("_n").alias("MatchCount"), F.max_by("_type", "_last").alias("PodType"))
    )
    digits = receiver_serial(F.col("RECEIVER"))
    return (
        deployments.join(found, "row_no", "left")
        .na.fill(0, ["MatchCount"])
        .na.fill("", ["PodType"])
        .withColumn("RowType", F.lit("metadata"))
        .withColumn("DeploymentID", deployment_id(F.col("STATION_NAME"), F.col("DEPLOY_DATE_TIME"), F.col("RECEIVER")))
        .withColumn("RECEIVER", F.when(F.col("MatchCount") > 0, digits).otherwise(F.col("RECEIVER")))
    )


def lower_name(name: str = "name_ext") -> Column:
    return F.lower(F.trim(name)).alias("lower_name")


def first_deployment(index: MatchIndex) -> DataFrame:
    """Lowest deployment row of each file name."""
    lowest = index.covered.groupBy(*BLOCK).agg(F.min("row_no").alias("row_no"))
    days = _meet(_in_blocks(index.files.select("serial", "day").distinct()), lowest, BLOCK)
    days = days.groupBy("serial", "day").agg(F.min("row_no").alias("row_no"))
    return (
        _meet(index.files, days, ["serial", "day"])
        .groupBy(lower_name())
        .agg(F.min("row_no").alias("row_no"))
    )


def file_only_rows(files: DataFrame, index: MatchIndex) -> DataFrame:
    """One row per train file name that no deployment matched, compared without case."""
    keyed = train_files(files).select("sel_no", "name_ext", lower_name())
    lone = first_row(
        ["lower_name"], [-F.col("sel_no")], keyed.join(first_deployment(index), "lower_name", "left_anti")
    )
    return lone.select(
        F.lit("file-only").alias("RowType"),
        F.col("name_ext").alias("FileName"),
        N.pod_type(F.col("name_ext")).alias("PodType"),
        F.lit(0).cast("long").alias("MatchCount"),
        "lower_name",
    )


def match_deployments(files: DataFrame, deployments: DataFrame, index: MatchIndex) -> DataFrame:
    """Annotated deployments, then a file-only row for each unmatched file name."""
    rows = annotate(deployments, index).withColumn("FileName", F.lit(None).cast("string"))
    alone = file_only_rows(files, index).drop("lower_name")
    return rows.unionByName(alone, allowMissingColumns=True)


def file_lists(pairs: DataFrame, per_row: int = LIST_FILES) -> DataFrame:
    """Matched files of each deployment as lists in selection order.

    A list holds at most ``per_row`` names and continues in the row with the next ``list_no``.
    """
    placed = number_in_groups(pairs, ["row_no"], order="sel_no")
    return (
        placed.withColumn("list_no", F.expr(f"(pos - 1) div {per_row}"))
        .groupBy("row_no", "list_no")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "name_ext"))).alias("_files"))
        .select("row_no", "list_no", F.col("_files.name_ext").alias("MatchingFiles"))
    )


def process_list(selected: DataFrame, files: DataFrame, index: MatchIndex, deployments: DataFrame) -> DataFrame:
    """Selected files with full path and first deployment; files without one are dropped.

    Rows keep ``sel_no``; sort by it for the order of selection.
    """
    paths = first_row(
        ["lower_name"], [F.col("file_no")], files.select(lower_name(), "path", F.col("sel_no").alias("file_no"))
    ).drop("file_no")
    meta = deployments.select(
        "row_no",
        F.col("DeploymentID").alias("deployment_id"),
        F.col("DEPLOY_DATE_TIME").alias("deploy"),
        F.col("VALID_DATA_UNTIL_DATE_TIME").alias("valid_until"),
    )
    return (
        selected.select("sel_no", "name_ext", lower_name())
        .join(paths, "lower_name")
        .join(first_deployment(index), "lower_name")
        .join(meta, "row_no")
        .drop("lower_name")
    )


def receivers(matched: DataFrame) -> DataFrame:
    """One row per receiver serial of the matched deployments; the first deployment wins."""
    rows = matched.filter(F.col("MatchCount") > 0).select(
        "row_no", F.col("RECEIVER").alias("RECEIVER_ID_SERIAL_NUMBER"), F.col("PodType").alias("RECEIVER_MODEL")
    )
    return first_row(["RECEIVER_ID_SERIAL_NUMBER"], [F.col("row_no")], rows).select(
        F.lit(MANUFACTURER).alias("RCV_MANUFACTURER"),
        "RECEIVER_ID_SERIAL_NUMBER",
        "RECEIVER_MODEL",
        F.lit(STATUS).alias("RCV_STATUS"),
    )


def detection_spans(detections: DataFrame, keys: tuple[str, ...] = ("PODfile",)) -> DataFrame:
    """First and last detection time of each file and the seconds between."""
    spans = detections.groupBy(*keys).agg(
        F.min("DETECTION_DATE_TIME").alias("first_time"), F.max("DETECTION_DATE_TIME").alias("last_time")
    )
    return spans.withColumn("span_seconds", T.seconds_between(F.col("first_time"), F.col("last_time")))


def file_overview(
    selected: DataFrame, index: MatchIndex, deployments: DataFrame, spans: DataFrame, status: DataFrame
) -> DataFrame:
    """Match, deployment length, detection span and status of each selected file.

    ``spans`` has PODfile and span_seconds, ``status`` has pod_file and status. Where both have ``family`` too, files
    of equal name and different family are told apart.
    """
    family = ["family"] if "family" in spans.columns and "family" in status.columns else []
    days = T.seconds_between(F.col("DEPLOY_DATE_TIME"), F.col("VALID_DATA_UNTIL_DATE_TIME"))
    lengths = deployments.select("row_no", T.format_duration(days).alias("_length"))
    owners = first_deployment(index).join(lengths, "row_no").select("lower_name", "_length")
    span = spans.select(*family, F.col("PODfile").alias("Filename"), T.format_duration(F.col("span_seconds")).alias("_span"))
    state = status.select(*family, F.col("pod_file").alias("Filename"), F.col("status").alias("_status"))
    return (
        selected.select("sel_no", N.stem(F.col("name_ext")).alias("Filename"), N.family(F.col("name_ext")).alias("family"), lower_name())
        .join(owners, "lower_name", "left")
        .join(span, ["Filename", *family], "left")
        .join(state, ["Filename", *family], "left")
        .select(
            "sel_no",
            "Filename",
            F.when(F.col("_length").isNotNull(), "Yes").otherwise("No").alias("MetadataMatch"),
            F.coalesce("_length", F.lit("N/A")).alias("MetadataDeployment"),
            F.coalesce("_span", F.lit("N/A")).alias("DetectionSpan"),
            F.coalesce("_status", F.lit("NOT ATTEMPTED")).alias("Status"),
        )
    )


def exact_name_flags(metadata: DataFrame, files: DataFrame) -> DataFrame:
    """``MATCH`` Y or N by membership of ``POD_FILE`` in the file names; files left over follow as N rows."""
    names = files.select(F.col("name_ext").alias("POD_FILE")).distinct().withColumn("_hit", F.lit(True))
    flagged = metadata.join(names, "POD_FILE", "left").withColumn(
        "MATCH", F.when(F.col("_hit"), "Y").otherwise("N")
    )
    left_over = (
        files.select(F.col("name_ext").alias("POD_FILE"))
        .join(metadata.select("POD_FILE").distinct(), "POD_FILE", "left_anti")
        .withColumn("MATCH", F.lit("N"))
    )
    return flagged.drop("_hit").unionByName(left_over, allowMissingColumns=True)

"""Deployment sheets: dates, column order, empties and checks."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from clickloom import spec as S
from clickloom.functions import text as T
from clickloom.session import new_folder


class MetadataError(ValueError):
    """A strict check found problems; the message has one line for each."""


def assemble_dates(df: DataFrame, datetimes: tuple[str, ...] = S.DATETIMES) -> DataFrame:
    """Replace the year, month, day and time columns of each date by one time stamp column."""
    out = df
    for target in datetimes:
        prefix = re.sub(r"_DATE(_TIME)?$", "", target)
        year, month, day, time = (f"{prefix}_{p}" for p in ("YEAR", "MONTH", "DAY", "TIME"))
        if not {year, month, day} <= set(df.columns):
            continue
        timed = time in df.columns
        value = T.assemble_timestamp(F.col(year), F.col(month), F.col(day), F.col(time) if timed else None)
        out = out.withColumn(f"{prefix}_DATE_TIME" if timed else f"{prefix}_DATE", value).drop(year, month, day)
        out = out.drop(time) if timed else out
    return out


def split_dates(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Inverse of :func:`assemble_dates`: column name to prefix of the parts."""
    parts = {}
    for column, prefix in columns.items():
        parts.update(T.split_timestamp(F.col(column), prefix))
    return df.withColumns(parts)


def upper_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])


def missing_mandatory(df: DataFrame, mandatory: tuple[str, ...] = S.MANDATORY) -> list[str]:
    """Names of absent mandatory columns; looks at the schema only."""
    present = {c.upper() for c in df.columns}
    return [c for c in mandatory if c not in present]


def missing_column_rows(df: DataFrame, mandatory: tuple[str, ...] = S.MANDATORY) -> DataFrame:
    """Absent mandatory columns as report rows, with the number of sheet rows they are absent from."""
    names = F.array(*[F.lit(c) for c in missing_mandatory(df, mandatory)]).cast("array<string>")
    return df.agg(F.count("*").alias("n_rows")).select(F.explode(names).alias("column_name"), "n_rows")


def empty_counts(df: DataFrame, mandatory: tuple[str, ...] = S.MANDATORY) -> DataFrame:
    """One row per mandatory column with its count of empty values, in one pass."""
    present = [c for c in mandatory if c in df.columns]
    counts = df.agg(*[F.count_if(T.is_blank(F.col(c))).alias(c) for c in present])
    return counts.unpivot([], present, "column_name", "n_empty")


def conform(df: DataFrame, marker: str = S.EMPTY_MARKER, all_columns: bool = False) -> DataFrame:
    """Columns of the specification in its order: absent ones added, others dropped, empties unified.

    Mandatory columns keep their values unless ``all_columns`` is set.
    """
    types = dict(df.dtypes)

    def column(name: str) -> Column:
        when = name in S.DATETIMES
        if name not in types:
            return (F.lit(None).cast("timestamp_ntz") if when else F.lit(marker)).alias(name)
        c = F.col(name)
        if name in S.MANDATORY and not all_columns:
            return c
        if when:
            clean = T.blank_to_null(c) if types[name] == "string" else c
        else:
            text = c.cast("string")
            clean = F.when(F.trim(F.coalesce(text, F.lit(""))) == "", marker).otherwise(text)
        return clean.alias(name)

    return df.select(*[c for c in ("row_no",) if c in types], *[column(c) for c in S.OUTPUT_ORDER])


def projects(df: DataFrame, column: str = "RCV_PROJECT") -> DataFrame:
    """Projects of the sheet with their row counts."""
    return (
        df.select(T.blank_to_null(F.col(column)).alias("project"))
        .filter(F.col("project").isNotNull())
        .groupBy("project")
        .agg(F.count("*").alias("n"))
        .withColumn("label", F.format_string("%s (n=%d)", "project", "n"))
    )


def of_project(df: DataFrame, project: str, strict: bool = False, column: str = "RCV_PROJECT") -> DataFrame:
    chosen = df.filter(T.blank_to_null(F.col(column)) == project.strip())
    if strict and chosen.isEmpty():
        raise MetadataError("Filtering produced 0 rows. Chosen project not found?")
    return chosen


def violation_rows(df: DataFrame, cases: list[tuple[str, Column, str | None, Column]]) -> DataFrame:
    """Rows (check_id, row_no, column_name, message) for every case that holds, in one pass."""
    found = [
        F.when(
            bad,
            F.struct(
                F.lit(check).alias("check_id"),
                F.lit(column).cast("string").alias("column_name"),
                message.alias("message"),
            ),
        )
        for check, bad, column, message in cases
    ]
    return (
        df.select("row_no", F.explode(F.array(*found)).alias("_v"))
        .filter(F.col("_v").isNotNull())
        .select("_v.check_id", F.col("row_no").cast("long").alias("row_no"), "_v.column_name", "_v.message")
    )


def date_cases(min_date: str = S.MIN_DATE, datetimes: tuple[str, ...] = S.DATETIMES):
    """Dates before the least allowed one; NULL passes."""
    least = F.lit(min_date).cast("timestamp_ntz")
    return [
        (
            "V3",
            F.col(c) < least,
            c,
            F.format_string("Row %d: %s is earlier than minDate.", F.col("row_no"), F.lit(c)),
        )
        for c in datetimes
    ]


# Earlier role, later role, message (fixed values).
ORDER_RULES = (
    ("DeployDate", "RecoverDate", "Deployment date must be before recovery date."),
    ("ActivationDate", "RecoverDate", "Activation date must be before recovery date."),
    ("ActivationDate", "ValidUntilDate", "Activation date must be before valid until date."),
    ("DeployDate", "ValidUntilDate", "Deployment date must be before valid until date."),
)


def order_cases(roles: dict[str, str] = S.ROLES):
    return [
        ("V4", F.col(roles[early]) > F.col(roles[late]), roles[early], F.lit(message))
        for early, late, message in ORDER_RULES
    ]


def coordinate_cases(roles: dict[str, str] = S.ROLES):
    error = T.coordinate_error(F.col(roles["Latitude"]).cast("string"), F.col(roles["Longitude"]).cast("string"))
    text = F.format_string("Row %d: %s", F.col("row_no"), error)
    return [("V5", error.isNotNull(), roles["Latitude"], text)]


def option_cases(options: dict[str, tuple[str, ...]] = S.OPTIONS):
    """Values outside the listed options; opt-in."""
    return [
        (
            "V10",
            ~T.is_blank(F.col(c)) & ~F.col(c).isin(*values, S.EMPTY_MARKER),
            c,
            F.format_string("Row %d: %s is not an option of %s.", F.col("row_no"), F.col(c), F.lit(c)),
        )
        for c, values in options.items()
    ]


def violations(df: DataFrame, with_options: bool = False) -> DataFrame:
    cases = date_cases() + order_cases() + coordinate_cases() + (option_cases() if with_options else [])
    return violation_rows(df, cases)


def with_numeric_coordinates(df: DataFrame, roles: dict[str, str] = S.ROLES) -> DataFrame:
    pair = (roles["Latitude"], roles["Longitude"])
    return df.withColumns({c: F.col(c).cast("string").try_cast("double") for c in pair})


# Messages of one check and column that the exception repeats; the written table has them all.
SHOWN = 1000


def raise_on(found: DataFrame) -> None:
    """Write the violations and raise with their messages, equal ones once.

    Every check and column that fails is named. Where one has more than ``SHOWN`` messages the rest is counted, and
    the exception names the written table (also as ``path``). A sheet without violations leaves no table.
    """
    if found.isEmpty():
        return
    folder = new_folder(found.sparkSession, "violations", kept=True)
    found.write.parquet(folder)
    table = found.sparkSession.read.schema(found.schema).parquet(folder)
    messages = table.groupBy("check_id", "column_name", "message").agg(F.min("row_no").alias("row_no"))
    order = W.partitionBy("check_id", "column_name").orderBy("row_no", "message")
    ranked = messages.withColumn("_n", F.row_number().over(order))
    shown = ranked.filter(F.col("_n") <= SHOWN).orderBy("row_no", "check_id", "column_name").collect()
    totals = messages.groupBy("check_id", "column_name").count().filter(F.col("count") > SHOWN)
    lines = list(dict.fromkeys(r.message for r in shown))
    more = [f"{r['count'] - SHOWN} more of {r.check_id} {r.column_name}" for r in totals.orderBy("check_id", "column_name").collect()]
    if more:
        lines.append(f"... {', '.join(more)}; all in {folder}")
    error = MetadataError("\n".join(lines))
    error.path = folder
    raise error


def check_columns(df: DataFrame) -> list[str]:
    """Problems of the mandatory columns: absent or with empty values."""
    issues = []
    absent = missing_mandatory(df)
    if absent:
        issues.append("Missing mandatory columns: " + ", ".join(absent))
    empty = [r.column_name for r in empty_counts(df).filter("n_empty > 0").collect()]
    if empty:
        issues.append("Mandatory columns contain empty values: " + ", ".join(empty))
    return issues


def prepare_deployments(sheet: DataFrame, project: str | None = None, strict: bool = True) -> DataFrame:
    """Sheet as read (with ``row_no``) to checked deployments of one project."""
    dated = assemble_dates(upper_names(sheet).withColumnRenamed("ROW_NO", "row_no"))
    if strict:
        issues = check_columns(dated)
        if issues:
            raise MetadataError("\n".join(issues))
    ordered = conform(dated)
    if strict and project is None:
        found = projects(ordered).limit(2).count()
        if found == 0:
            raise MetadataError("RCV_PROJECT contains no valid values.")
        if found > 1:
            raise MetadataError("Several projects in the sheet: choose one.")
    if project is not None:
        ordered = of_project(ordered, project, strict)
    if strict:
        raise_on(violations(ordered))
    return with_numeric_coordinates(ordered)

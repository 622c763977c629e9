"""Column expressions over detector file names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Patterns of the naming rules (fixed values).
EXTENSIONS = ("CP1", "CP3", "FP1", "FP3")
DETECTOR_EXT = r"(?i)\.(?:CP|FP)[13]$"
INNER_EXT = r"(?i)\.(?:CP|FP)[13](?=\.(?:CP|FP)[13]\b)"
LAST_EXT = r"\.[^.]+$"
LOOSE_DATE = r"(?<!\d)(\d{4})\D+(0?[1-9]|1[0-2])\D+(0?[1-9]|[12]\d|3[01])(?!\d)"
STRICT_DATE = r"(?<!\w)(\d{4})\s+(\d{2})\s+(\d{2})(?!\w)"
SERIAL = r"(?i)(?:F?C?POD)[_\s]*(\d+)"
FILE_NUMBER = r"(?i)file\s*(\d+)"
PART_SUFFIX = r"(?i)\s+PART.*$"
SOFTWARE_SUFFIX = r"(?i)(?:^|[_\s-])(FPODsoftware|CPODsoftware)\b"
EXTRA_STATION = r"POD\d+\s+[A-Za-z]+[A-Za-z0-9]*\s+file"
POD_TOKEN = r"POD\d+"

NO_DATE, NO_SERIAL, NO_NUMBER = "UNKNOWNDATE", "UNKNOWN", "NA"


def extension(name: Column) -> Column:
    """Upper-case text after the last dot; empty without one."""
    return F.upper(F.regexp_extract(name, r"\.([^.]*)$", 1))


def stem(name: Column) -> Column:
    """Name without its last extension."""
    return F.regexp_replace(name, LAST_EXT, "")


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/\\]*)$", 1)


def has_double_extension(name: Column) -> Column:
    return stem(name).rlike(DETECTOR_EXT)


def is_train_file(name: Column) -> Column:
    """CP3 and FP3 files hold the classified trains."""
    return F.lower(name).rlike(r"\.[cf]p3$")


def family(name: Column) -> Column:
    """CP or FP by the extension, else empty."""
    ext = extension(name)
    return F.when(ext.startswith("CP"), "CP").when(ext.startswith("FP"), "FP").otherwise("")


def pod_type(name: Column) -> Column:
    return F.when(extension(name) == "CP3", "C-POD").when(extension(name) == "FP3", "F-POD")


def variant_stem(name: Column) -> Column:
    return F.regexp_replace(name, DETECTOR_EXT, "")


def strict_day(name: Column) -> Column:
    """Day of a ``YYYY MM DD`` token of its own; NULL when absent or no calendar day."""
    part = [F.regexp_extract(stem(name), STRICT_DATE, i) for i in (1, 2, 3)]
    text = F.concat_ws("-", *part)
    return F.when(part[0] != "", text).try_cast("date")


def serial(name: Column) -> Column:
    """Digits after the first POD token; NULL without one."""
    return F.nullif(F.regexp_extract(name, SERIAL, 1), F.lit(""))


FIELDS = (
    "date_str", "serial", "file_no", "family", "kind", "has_part", "has_soft", "name_score",
    "base_key", "pair_key", "pair_group_key", "pair_variant_key",
)


def with_fields(files: DataFrame, name: str = "name_ext") -> DataFrame:
    """All fields of the detector file names, in steps so that no pattern is evaluated twice."""
    whole = F.regexp_replace(F.coalesce(name, F.lit("")), INNER_EXT, "")
    split = files.withColumn("_whole", whole).withColumns(
        {"_core": stem(F.col("_whole")), "_ext": extension(F.col("_whole"))}
    )
    core, ext = F.col("_core"), F.col("_ext")
    found = split.withColumns(
        {
            **{f"_{part}": F.regexp_extract(core, LOOSE_DATE, i) for i, part in enumerate("ymd", 1)},
            "_serial": serial(core),
            # Without surplus leading zeros.
            "_number": F.regexp_replace(F.regexp_extract(core, FILE_NUMBER, 1), r"^0+(?=\d)", ""),
            "has_part": core.rlike(PART_SUFFIX),
            "has_soft": core.rlike(SOFTWARE_SUFFIX),
        }
    )
    date = F.concat("_y", F.lpad("_m", 2, "0"), F.lpad("_d", 2, "0"))
    two_digits = F.when(F.length("_number") < 2, F.lpad("_number", 2, "0")).otherwise(F.col("_number"))
    score = (
        core.rlike(EXTRA_STATION).cast("int") * 3
        + (F.regexp_count(core, F.lit(POD_TOKEN)) > 1).cast("int") * 3
        + F.col("has_part").cast("int") * 2
        + F.col("has_soft").cast("int") * 2
        + (F.col("_number") == "").cast("int") * 5
    )
    named = found.withColumns(
        {
            "date_str": F.when(F.col("_y") != "", date).otherwise(NO_DATE),
            "serial": F.coalesce("_serial", F.lit(NO_SERIAL)),
            "file_no": F.when(F.col("_number") == "", NO_NUMBER).otherwise(two_digits),
            "family": F.when(ext.startswith("CP"), "CP").when(ext.startswith("FP"), "FP").otherwise(""),
            "kind": F.regexp_replace(ext, r"^[A-Z]+", ""),
            "name_score": score,
        }
    )
    keyed = named.withColumn("base_key", F.concat_ws("_", "date_str", "serial", "file_no")).withColumns(
        {
            "pair_key": F.concat_ws("_", "base_key", "family", "kind"),
            "pair_group_key": F.concat_ws("_", "base_key", "family"),
            "pair_variant_key": F.concat_ws("_", variant_stem(F.col(name)), F.col("family")),
        }
    )
    return keyed.select(*files.columns, *FIELDS)

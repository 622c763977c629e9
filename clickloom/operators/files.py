"""Detector file lists: duplicates, pairs and the best variant of a recording.

A file list has ``sel_no`` (order of selection), ``path``, ``name_ext`` and ``bytes``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clickloom.functions import filenames as N
from clickloom.operators.ordering import first_row
from clickloom.session import write_and_read

STEM = ["stem", "family"]


# Texts of the reports (fixed values).
PAIR_MESSAGE = (
    "Found %d problematic file(s): %d with multiple CP/FP tokens in the filename, "
    "%d lacking a matching pair (.CP1/.CP3 or .FP1/.FP3).\nSee the 'missing' list for full paths."
)
UNKNOWN_KIND = "Extension kind not recognized as '1' or '3'."
LACKS_KINDS = "Variant lacks both kinds (N=%d, HasKinds=%d)."
WORSE_VARIANT = (
    "Dedup by pair: this variant SumScore=%s, SumBytes=%s, MinScore=%s; "
    'best variant "%s" SumScore=%s, SumBytes=%s, MinScore=%s.'
)


def drop_copies(files: DataFrame) -> DataFrame:
    """First file of each (name without case, size)."""
    keyed = files.withColumn("_lower", F.lower("name_ext"))
    return first_row(["_lower", "bytes"], [F.col("sel_no")], keyed).select(*files.columns)


def with_name_fields(files: DataFrame) -> DataFrame:
    return N.with_fields(files)


def unsupported(files: DataFrame) -> DataFrame:
    """Files whose extension is none of the four detector formats."""
    ext = N.extension(F.col("name_ext"))
    return files.filter(~ext.isin(*N.EXTENSIONS)).withColumn(
        "message",
        F.concat(
            F.lit("Unsupported file type: ."),
            ext,
            F.lit(". Supported types: " + ", ".join("." + e for e in N.EXTENSIONS) + "."),
        ),
    )


def double_extensions(files: DataFrame) -> DataFrame:
    return files.filter(N.has_double_extension(F.col("name_ext")))


def _single(files: DataFrame) -> DataFrame:
    name = F.col("name_ext")
    ext = N.extension(name)
    return files.filter(~N.has_double_extension(name)).withColumns(
        {"stem": N.stem(name), "family": F.substring(ext, 1, 2), "kind": F.substring(ext, 3, 1)}
    )


def stems(files: DataFrame) -> DataFrame:
    """One row per base name and family: which of the two kinds it has."""
    return (
        _single(files)
        .groupBy(*STEM)
        .agg(F.max(F.col("kind") == "1").alias("has_1"), F.max(F.col("kind") == "3").alias("has_3"))
    )


def paired_stems(files: DataFrame) -> DataFrame:
    """Base names with both kinds."""
    return stems(files).filter(F.col("has_1") & F.col("has_3")).select(*STEM)


def lone_stems(files: DataFrame, kind: str) -> DataFrame:
    """Base names with only the given kind: a set difference as one aggregate."""
    other = "has_3" if kind == "1" else "has_1"
    return stems(files).filter(F.col(f"has_{kind}") & ~F.col(other)).select(*STEM)


def paired(files: DataFrame) -> DataFrame:
    """Files that have their partner."""
    return _single(files).join(paired_stems(files), STEM, "left_semi").drop(*STEM, "kind")


def pair_problems(files: DataFrame, both_ways: bool = True) -> DataFrame:
    """Paths to put right: double extensions first, then files without partner.

    ``place`` orders the groups of the report; train files without a raw partner count only with
    ``both_ways``.
    """
    lone = (F.col("has_1") & ~F.col("has_3")) | (F.lit(both_ways) & F.col("has_3") & ~F.col("has_1"))
    place = F.when(F.col("kind") == "1", 1).otherwise(3) + (F.col("family") == "FP").cast("int")
    alone = (
        _single(files)
        .join(stems(files).filter(lone), STEM)
        .select("path", F.lit("NO_PARTNER").alias("problem"), place.alias("place"), "sel_no")
    )
    double = double_extensions(files).select(
        "path", F.lit("DOUBLE_EXTENSION").alias("problem"), F.lit(0).alias("place"), "sel_no"
    )
    both = double.unionByName(alone)
    return first_row(["path"], [F.col("place"), F.col("sel_no")], both)


def pair_message(problems: DataFrame) -> DataFrame:
    """One row: the summary message, empty without problems."""
    counts = problems.agg(
        F.count("*").alias("n"), F.count_if(F.col("problem") == "DOUBLE_EXTENSION").alias("n_double")
    )
    text = F.format_string(
        PAIR_MESSAGE,
        "n",
        "n_double",
        F.col("n") - F.col("n_double"),
    )
    return counts.select((F.col("n") == 0).alias("is_valid"), F.when(F.col("n") == 0, "").otherwise(text).alias("message"))


def pair_check(files: DataFrame, both_ways: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(files with their partner, problem paths, one-row summary)."""
    problems = pair_problems(files, both_ways)
    return paired(files), problems, pair_message(problems)


def variants(parsed: DataFrame) -> DataFrame:
    """Metrics per variant (files that share a stem and family)."""
    return parsed.groupBy("pair_variant_key", "pair_group_key").agg(
        F.count("*").alias("n"),
        (F.max(F.col("kind") == "1") & F.max(F.col("kind") == "3")).alias("has_kinds"),
        F.sum("name_score").alias("sum_score"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("sum_bytes"),
        F.min("name_score").alias("min_score"),
        F.min_by("name_ext", "sel_no").alias("first_name"),
    )


METRICS = ("n", "has_kinds", "sum_score", "sum_bytes", "min_score", "first_name")


def best_variants(metrics: DataFrame) -> DataFrame:
    """Best complete variant of each group: lowest score, most bytes, lowest least score, first name."""
    complete = metrics.filter(F.col("has_kinds") & (F.col("n") >= 2))
    return first_row(
        ["pair_group_key"],
        [F.col("sum_score"), -F.col("sum_bytes"), F.col("min_score"), F.col("first_name"), F.col("pair_variant_key")],
        complete,
    ).select(
        "pair_group_key",
        F.col("pair_variant_key").alias("best_variant_key"),
        F.regexp_replace("pair_variant_key", r"(?i)_(?:CP|FP)$", "").alias("best_variant_name"),
        *[F.col(m).alias(f"best_{m}") for m in METRICS],
    )


def short_number(c: Column) -> Column:
    """Up to six significant digits, exponent form from a million on."""
    mantissa = F.regexp_replace(F.format_string("%.5e", c.cast("double")), r"\.?0+e", "e")
    return F.when(c.isNull(), "NaN").when(F.abs(c) < 1_000_000, c.cast("string")).otherwise(mantissa)


def _judged(parsed: DataFrame) -> DataFrame:
    metrics = variants(parsed)
    judged = parsed.join(metrics, ["pair_variant_key", "pair_group_key"], "left").join(
        best_variants(metrics), "pair_group_key", "left"
    )
    keep = F.coalesce(F.col("pair_variant_key") == F.col("best_variant_key"), F.lit(False))
    return judged.withColumn("keep", keep & F.col("kind").isin("1", "3"))


def reject_reason() -> tuple[Column, Column]:
    """Reason code and text over the columns of a judged file list."""
    bad_kind = ~F.col("kind").isin("1", "3")
    no_pair = ~F.coalesce(F.col("has_kinds"), F.lit(False)) | (F.col("n") < 2)
    code = F.when(bad_kind, "INVALID_EXTKIND").when(no_pair, "NOT_PAIR_13").otherwise("WORSE_VARIANT")
    pieces = F.format_string(
        WORSE_VARIANT,
        short_number(F.col("sum_score")),
        short_number(F.col("sum_bytes")),
        short_number(F.col("min_score")),
        "best_variant_name",
        short_number(F.col("best_sum_score")),
        short_number(F.col("best_sum_bytes")),
        short_number(F.col("best_min_score")),
    )
    text = (
        F.when(bad_kind, UNKNOWN_KIND)
        .when(
            no_pair,
            F.format_string(
                LACKS_KINDS,
                F.coalesce("n", F.lit(0)),
                F.coalesce(F.col("has_kinds").cast("int"), F.lit(0)),
            ),
        )
        .otherwise(pieces)
    )
    return code, text


def kept_order() -> list[Column]:
    return [F.col("pair_group_key"), F.col("kind"), F.col("name_score"), F.col("bytes").desc(), F.col("sel_no")]


def best_files(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split paired files into the best variant of each recording and the rejected rest with reasons."""
    return _split(_judged(with_name_fields(files)))


def _split(judged: DataFrame) -> tuple[DataFrame, DataFrame]:
    code, text = reject_reason()
    kept = judged.filter("keep").drop(
        "keep", *METRICS, "best_variant_key", "best_variant_name", *[f"best_{m}" for m in METRICS]
    )
    rejected = judged.filter(~F.col("keep")).select(
        "path", "name_ext", "family", "kind", "pair_group_key", "pair_variant_key", "name_score", "bytes",
        F.col("n").alias("variant_n"),
        F.col("has_kinds").alias("variant_has_kinds"),
        F.col("sum_score").alias("variant_sum_score"),
        F.col("sum_bytes").alias("variant_sum_bytes"),
        F.col("min_score").alias("variant_min_score"),
        "best_variant_name", "best_sum_score", "best_sum_bytes", "best_min_score",
        code.alias("reason"),
        text.alias("reason_detail"),
    )
    return kept, rejected


def dedup_files(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Exact copies dropped, unpaired files dropped, best variant kept: (kept, rejected).

    The parsed list feeds the metrics, the choice and both results, so it is written once.
    """
    return _split(_judged(write_and_read(with_name_fields(paired(drop_copies(files))), "paired-files")))

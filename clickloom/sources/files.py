"""Detector file listing, deployment sheets and vendor exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickloom import spec as S
from clickloom.functions import filenames as N
from clickloom.operators.ordering import number_as_read, number_rows
from clickloom.sources.listing import can_list, list_files

NAME_GLOB = "*.[CcFf][Pp][13]"
NAME_PATTERN = r"\.[CcFf][Pp][13]$"


def detector_files(spark: SparkSession, root: str) -> DataFrame:
    """path, length and modificationTime of the detector files under ``root``.

    Tasks list them; only file systems that tasks cannot open are listed by Spark's file index, on the driver.
    """
    if can_list(root):
        return list_files(spark, root, NAME_PATTERN)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", NAME_GLOB)
    return files.load(root).select("path", "length", "modificationTime")


def list_pod_files(spark: SparkSession, root: str) -> DataFrame:
    """Detector files under ``root``: sel_no (path order), path, name_ext, bytes. File contents are not read."""
    found = detector_files(spark, root).select("path", N.base_name(F.col("path")).alias("name_ext"), F.col("length").alias("bytes"))
    return number_rows(found, [], ["path"], out="sel_no")


def read_sheet(spark: SparkSession, path: str, columns: int = S.SHEET_COLUMNS) -> DataFrame:
    """First ``columns`` columns of a deployment sheet, all text, with ``row_no`` in file order.

    ``path`` is a file or a folder of parts, which follow each other by name. Quoted cells may hold line breaks;
    for that a part is read by one task.
    """
    options = {"header": True, "multiLine": True, "escape": '"', "mode": "PERMISSIVE"}
    names = spark.read.options(**options).csv(path).columns
    schema = ", ".join(f"`{n}` string" for n in names)
    return number_as_read(spark.read.options(**options).schema(schema).csv(path), names[:columns])


def read_vendor_export(spark: SparkSession, path: str) -> DataFrame:
    """Minutes (``dt``) and click counts (``nall_m``) of a vendor export."""
    names = spark.read.option("header", True).csv(path).columns
    schema = ", ".join(f"`{n}` string" for n in names)
    table = spark.read.option("header", True).schema(schema).csv(path)
    return table.select(
        F.try_to_timestamp("ChunkEnd", F.lit("dd/MM/yyyy HH:mm")).cast("timestamp_ntz").alias("dt"),
        F.col("Nall_m").try_cast("long").alias("nall_m"),
    )

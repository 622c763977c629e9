"""Listing of detector files by tasks, folder by folder.

Spark's own file index holds every status on the driver. Here the folders of a level are dealt to tasks, each task lists
its folders, and what it finds is written: files, and the folders of the next level. The driver learns how many folders a
level has and nothing else, so millions of files cost it nothing; a folder itself is listed by one task.

As in Spark, names that start with a dot or an underscore are left out. Paths are those that Spark would give.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from clickloom.session import write_and_read
from clickloom.sources.records import KNOWN_SCHEMES, MAX_TASKS, filesystem

FOLDERS_PER_TASK = 16

_SCHEMA = pa.schema([("path", pa.string()), ("length", pa.int64()), ("modified_us", pa.int64()), ("is_folder", pa.bool_())])


def can_list(root: str) -> bool:
    """Whether tasks can list a folder of this file system."""
    scheme = re.match("([A-Za-z][A-Za-z0-9+.-]*):", root)
    return (scheme.group(1).lower() if scheme else "") in KNOWN_SCHEMES


def lead_of(path: str, inner: str) -> str:
    """What stands before the paths of a file system in the paths of Spark."""
    lead = path[: len(path) - len(inner)] if path.endswith(inner) else ""
    return "file:" if lead in ("", "file://") else lead


def _folder(path: str, name: re.Pattern) -> pa.RecordBatch:
    system, inner = filesystem(path.rstrip("/") or "/")
    lead = lead_of(path.rstrip("/") or "/", inner)
    found = [i for i in system.get_file_info(fs.FileSelector(inner)) if i.base_name[:1] not in (".", "_")]
    kept = [i for i in found if i.type == fs.FileType.Directory or i.type == fs.FileType.File and name.search(i.base_name)]
    folders = [i.type == fs.FileType.Directory for i in kept]
    times = [None if i.mtime_ns is None else i.mtime_ns // 1_000_000 * 1000 for i in kept]  # to the millisecond, as Spark has them
    columns = [[lead + i.path for i in kept], [0 if d else i.size for i, d in zip(kept, folders, strict=True)], times, folders]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SCHEMA, strict=True)], schema=_SCHEMA)


def _lister(pattern: str):
    name = re.compile(pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                yield _folder(path, name)

    return run


def list_files(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """path, length and modificationTime of the files below ``root`` whose names hold ``pattern``, a regular expression."""
    level, n = spark.createDataFrame([(root,)], "path string"), 1
    levels = []
    while n:
        tasks = max(1, min(n // FOLDERS_PER_TASK, MAX_TASKS))
        listed = level.repartition(tasks).mapInArrow(_lister(pattern), "path string, length long, modified_us long, is_folder boolean")
        listed = write_and_read(listed, "listing")
        levels.append(listed.filter("NOT is_folder"))
        level = listed.filter("is_folder").select("path")
        n = level.count()
    found = levels[0]
    for more in levels[1:]:
        found = found.unionByName(more)
    return found.select("path", "length", F.timestamp_micros("modified_us").alias("modificationTime"))

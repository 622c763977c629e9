"""Fixed-width detector files as Spark rows.

Files are cut into ranges of whole records; each range is one input row of a distributed read, so a file of any length
is read by many tasks. (Listing the files, in ``sources.files``, goes through the driver as Spark's file index does.)

A file that is gone, or shorter than listed or than its header, stays so however often it is read: its range yields a
row with ``error`` set. Every other failure (time-outs, permissions, broken connections) rises, so that Spark
tries the task again and a passing fault never becomes a lost file. File systems that are not known stop a read
before it starts.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from clickloom.functions import records as R
from clickloom.layout import LAYOUTS, MARKER, Layout

SPLIT_BYTES = 128 << 20
BLOCK_BYTES = 4 << 20
# Tasks for one read; beyond it a task takes several ranges. 50,000 ranges are 6 TB.
MAX_TASKS = 50_000


class Quarantine(Exception):
    """A file that can never be read whole."""
HEADERS_PER_TASK = 64


def record_count(length: Column, layout: Layout) -> Column:
    """Whole records after the header."""
    records = F.floor((length - layout.header_bytes) / layout.record_bytes)
    return F.greatest(records, F.lit(0).cast("long"))


def file_ends(files: DataFrame, kind: str) -> DataFrame:
    """Last record number of each file, from its length."""
    return files.select("pod_file", record_count(F.col("bytes"), LAYOUTS[kind]).alias("last_rec"))


# Hadoop names of file systems that Arrow knows under another one.
ARROW_SCHEMES = {"s3a": "s3", "s3n": "s3"}


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """File system and inner path of a local path or a URI as Spark lists it (spaces not encoded)."""
    parts = urlsplit(path)
    if parts.scheme in ("", "file"):
        return fs.LocalFileSystem(), path[path.index(":") + 1 :].replace("///", "/", 1) if parts.scheme else path
    scheme = ARROW_SCHEMES.get(parts.scheme, parts.scheme)
    rest = path[len(parts.scheme) + 3 + len(parts.netloc) :]
    return fs.FileSystem.from_uri(f"{scheme}://{parts.netloc}{quote(rest)}")


def _open(path: str):
    system, inner = filesystem(path)
    try:
        return system.open_input_file(inner)
    except FileNotFoundError as error:
        raise Quarantine(f"FileNotFoundError: {error}") from error


# Schemes that Arrow reads, with the names Hadoop has for them.
KNOWN_SCHEMES = {"", "file", "hdfs", "viewfs", "s3", "gs", "gcs", "abfs", "abfss", "mock", *ARROW_SCHEMES}


def check_schemes(schemes: list[str]) -> None:
    unknown = sorted(set(schemes) - KNOWN_SCHEMES)
    if unknown:
        raise ValueError(f"files of these file systems cannot be read: {', '.join(unknown)}")


def record_blocks(path: str, layout: Layout, first: int, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """Records ``first`` (0-based) to ``first + n`` in blocks, with the 1-based number of the first one."""
    step = max(1, BLOCK_BYTES // layout.record_bytes)
    with _open(path) as source:
        for at in range(first, first + n, step):
            want = min(step, first + n - at)
            source.seek(layout.header_bytes + at * layout.record_bytes)
            data = source.read(want * layout.record_bytes)
            if len(data) < want * layout.record_bytes:
                raise Quarantine(f"OSError: file ends inside record {at + len(data) // layout.record_bytes + 1}")
            yield at + 1, np.frombuffer(data, np.uint8).reshape(want, layout.record_bytes)


def failure(schema: pa.Schema, name: str, error: Exception) -> pa.RecordBatch:
    """The row of a quarantined range."""
    values = {"pod_file": name, "error": str(error)}
    return pa.RecordBatch.from_arrays([pa.array([values.get(f.name)], f.type) for f in schema], schema=schema)


def ranges(files: DataFrame, layout: Layout, split_bytes: int, carry: tuple[str, ...] = ()) -> DataFrame:
    """Ranges of whole records: pod_file, path, no, first, n. A file without records keeps one empty range."""
    per_split = max(1, split_bytes // layout.record_bytes)
    total = record_count(F.col("bytes"), layout)
    cut = files.select("pod_file", *carry, "path", total.alias("total"))
    last = F.greatest(F.floor((F.col("total") - 1) / per_split), F.lit(0).cast("long"))
    return cut.withColumn("no", F.explode(F.sequence(F.lit(0).cast("long"), last))).select(
        "pod_file",
        *carry,
        "path",
        "no",
        (F.col("no") * per_split).alias("first"),
        F.least(F.lit(per_split), F.col("total") - F.col("no") * per_split).cast("long").alias("n"),
    )


def spread(splits: DataFrame, max_tasks: int | None = None) -> DataFrame:
    """One range a task, as far as ``max_tasks`` goes; file systems that cannot be read stop here."""
    scheme = F.regexp_extract("path", "^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    found = splits.agg(F.count("*").alias("n"), F.collect_set(F.lower(scheme)).alias("schemes")).first()
    check_schemes(found["schemes"])
    tasks = max(1, min(found["n"], max_tasks or MAX_TASKS))
    # Ranges sort evenly; dealing them round and round from several partitions would give some tasks two.
    return splits.repartitionByRange(tasks, "pod_file", "path", "no") if tasks > 1 else splits.coalesce(1)


def _arrow_reader(kind: str, bytes_wanted: tuple[int, ...], types: tuple[int, ...] | None, carried: pa.Schema, markers: bool):
    layout = LAYOUTS[kind]
    fields = [pa.field("pod_file", pa.string()), *carried, pa.field("rec_no", pa.int64()), pa.field("rec_type", pa.int32())]
    fields += [pa.field(f"b{i}", pa.int32()) for i in bytes_wanted]
    if markers:
        fields += [pa.field("split", pa.int64()), pa.field("markers", pa.int64())]
    schema = pa.schema([*fields, pa.field("error", pa.string())])
    keep = np.zeros(256, bool)
    keep[list(types) if types is not None else slice(None)] = True
    keep[list(layout.dropped_types if types is None else [])] = False

    def rows(split: dict, start: int, block: np.ndarray, marked: np.ndarray) -> pa.RecordBatch:
        kinds = block[:, layout.type_byte - 1]
        at = np.flatnonzero(keep[kinds])
        columns = [pa.repeat(pa.scalar(split[f.name], f.type), len(at)) for f in [schema[0], *carried]]
        columns += [pa.array(start + at, pa.int64()), pa.array(kinds[at].astype(np.int32))]
        columns += [pa.array(block[at, i - 1].astype(np.int32)) for i in bytes_wanted]
        if markers:
            columns += [pa.repeat(pa.scalar(split["no"], pa.int64()), len(at)), pa.array(marked[at])]
        return pa.RecordBatch.from_arrays([*columns, pa.nulls(len(at), pa.string())], schema=schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for split in batch.to_pylist():
                seen = 0
                try:
                    for start, block in record_blocks(split["path"], layout, split["first"], split["n"]):
                        marked = seen + np.cumsum(block[:, layout.type_byte - 1] == MARKER, dtype=np.int64)
                        seen = int(marked[-1])
                        yield rows(split, start, block, marked)
                except Quarantine as error:
                    yield failure(schema, split["pod_file"], error)

    return read


def read_records(
    files: DataFrame,
    kind: str,
    bytes_wanted: tuple[int, ...] = (),
    types: tuple[int, ...] | None = None,
    split_bytes: int = SPLIT_BYTES,
    carry: tuple[str, ...] = (),
    markers: bool = False,
) -> DataFrame:
    """Rows (pod_file, rec_no, rec_type, b<i> ..., error) of the given files of one kind.

    ``files`` has pod_file, path and bytes. ``bytes_wanted`` names the 1-based bytes to return and
    ``types`` the record types; both are applied in the reader, before any row reaches Spark.
    ``carry`` names columns of ``files`` to repeat on every record, which saves a join of all records
    by file. ``markers`` adds the number of the ``split`` and the ``markers`` in it up to the record.
    """
    kept = files.select(*carry)
    columns = ["pod_file string", *[f"{c} {t}" for c, t in kept.dtypes], "rec_no long", "rec_type int"]
    columns += [f"b{i} int" for i in bytes_wanted]
    columns += ["split long", "markers long"] if markers else []
    reader = _arrow_reader(kind, bytes_wanted, types, to_arrow_schema(kept.schema), markers)
    splits = ranges(files, LAYOUTS[kind], split_bytes, carry)
    return spread(splits).mapInArrow(reader, ", ".join([*columns, "error string"]))


def read_headers(files: DataFrame, kind: str) -> DataFrame:
    """Header facts of each file: start time, tilt limits, version; ``error`` where unreadable."""
    size = LAYOUTS[kind].header_bytes
    schema = pa.schema([("pod_file", pa.string()), ("header", pa.binary()), ("error", pa.string())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for row in batch.to_pylist():
                try:
                    with _open(row["path"]) as source:
                        header = source.read(size)
                    short = None if len(header) == size else "OSError: file is shorter than its header"
                    out.append((row["pod_file"], None if short else header, short))
                except Quarantine as error:
                    out.append((row["pod_file"], None, str(error)))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    scheme = F.regexp_extract("path", "^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    found = files.agg(F.count("*").alias("n"), F.collect_set(F.lower(scheme)).alias("schemes")).first()
    check_schemes(found["schemes"])
    tasks = max(1, min(found["n"] // HEADERS_PER_TASK, MAX_TASKS))
    raw = files.select("pod_file", "path").repartition(tasks).mapInArrow(read, "pod_file string, header binary, error string")
    return raw.select("pod_file", *[v.alias(k) for k, v in R.header_facts(F.col("header")).items()], "error")


def without_errors(records: DataFrame) -> DataFrame:
    return records.filter(F.col("error").isNull()).drop("error")


def failures(*tables: DataFrame) -> DataFrame:
    """First error of each file over several reads."""
    both = tables[0].filter(F.col("error").isNotNull()).select("pod_file", "error")
    for table in tables[1:]:
        both = both.unionByName(table.filter(F.col("error").isNotNull()).select("pod_file", "error"))
    return both.groupBy("pod_file").agg(F.min("error").alias("error"))

"""Detector files as a Spark source of its own: ``spark.read.format("detector_records")``.

Options: ``kind`` (CP1, CP3, FP1 or FP3); ``path``, a folder searched at any depth, or ``files``, a Parquet table with
pod_file, path and bytes; ``split_bytes``, the bytes of one range; ``pushdown``, whether filters are taken over. The schema
asked for decides which bytes of a record are decoded: any of pod_file, rec_no, rec_type, b<i> (the 1-based bytes) and error.

A partition is a range of whole records, or several where there are more than ``MAX_TASKS``. Filters on names choose files
before anything is opened, filters on rec_no choose ranges and blocks, filters on rec_type and bytes are applied to a
block before rows are made of it. What a pushed filter settles is not tested again by Spark.

``pushdown`` is off unless asked for: Spark keeps one reader for each ``load()``, and where one plan uses the same frame
twice with different filters, both uses get the reader of the last one. With ``pushdown`` load once for each use.

A range that can never be read gives a row with ``error``, as in :mod:`clickloom.sources.records`. Filters on a record's
values drop such a row like every row that lacks the values, so the read fails instead, unless ``error IS NULL`` is asked for
as well: no file is lost unseen. Without an ``error`` column the read fails, too.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as D
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from clickloom.layout import LAYOUTS
from clickloom.session import write_and_name
from clickloom.sources.listing import lead_of
from clickloom.sources.records import MAX_TASKS, SPLIT_BYTES, Quarantine, check_schemes, filesystem, record_blocks

FORMAT = "detector_records"
_BYTE = re.compile(r"b([1-9]\d*)$")
_COMPARE = {
    D.EqualTo: np.equal,
    D.GreaterThan: np.greater,
    D.GreaterThanOrEqual: np.greater_equal,
    D.LessThan: np.less,
    D.LessThanOrEqual: np.less_equal,
}


def _listed(path: str, kind: str) -> list[tuple[str, str, int]]:
    """(pod_file, path, bytes) of the files of one kind below a folder, by path."""
    system, inner = filesystem(path)
    lead = lead_of(path, inner)
    found = system.get_file_info(fs.FileSelector(inner, recursive=True))
    files = [f for f in found if f.type == fs.FileType.File and f.extension.upper() == kind]
    return sorted((f.base_name[: -len(f.extension) - 1], lead + f.path, f.size) for f in files)


def _tabled(path: str) -> list[tuple[str, str, int]]:
    system, inner = filesystem(path)
    table = pq.read_table(inner, filesystem=system, columns=["pod_file", "path", "bytes"], use_threads=False)
    return list(zip(*(table.column(c).to_pylist() for c in ("pod_file", "path", "bytes")), strict=True))


@dataclass
class Range(D.InputPartition):
    """Ranges of one task: (pod_file, path, first record, number of records)."""

    parts: list[tuple[str, str, int, int]]


@dataclass
class _Wanted:
    """What the pushed filters leave over."""

    names: list[D.Filter] = field(default_factory=list)
    records: list[D.Filter] = field(default_factory=list)
    without_errors: bool = False


class DetectorRecords(D.DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        """Everything a record holds."""
        layout = self._layout()
        whole = [StructField(f"b{i}", IntegerType()) for i in range(1, layout.record_bytes + 1)]
        lead = [StructField("pod_file", StringType()), StructField("rec_no", LongType()), StructField("rec_type", IntegerType())]
        return StructType([*lead, *whole, StructField("error", StringType())])

    def _layout(self):
        kind = self.options.get("kind", "").upper()
        if kind not in LAYOUTS:
            raise ValueError(f"option kind must be one of {', '.join(LAYOUTS)}, not {kind!r}")
        return LAYOUTS[kind]

    def reader(self, schema: StructType) -> RecordReader:
        layout = self._layout()
        known = {f.name: f.dataType for f in self.schema()}
        wrong = [f.name for f in schema if known.get(f.name) != f.dataType]
        if wrong:
            raise ValueError(f"{layout.name} records have no such columns, or of another type: {', '.join(wrong)}")
        if ("path" in self.options) == ("files" in self.options):
            raise ValueError("give one of the options path and files")
        return RecordReader(layout.name, schema.names, dict(self.options))


class RecordReader(D.DataSourceReader):
    def __init__(self, kind: str, columns: list[str], options: dict[str, str]):
        self.kind, self.columns = kind, columns
        self.path, self.files = options.get("path"), options.get("files")
        self.split_bytes = int(options.get("split_bytes", SPLIT_BYTES))
        self.pushdown = options.get("pushdown", "false").lower() == "true"
        self.wanted = _Wanted()

    # ---- planning

    def pushFilters(self, filters: list[D.Filter]) -> Iterable[D.Filter]:
        if not self.pushdown:
            yield from filters
            return
        for f in filters:
            column = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            known = type(f) in _COMPARE or isinstance(f, (D.In, D.IsNotNull))
            if column == "pod_file" and (isinstance(f, (D.EqualTo, D.In, D.StringStartsWith)) or isinstance(f, D.IsNotNull)):
                self.wanted.names.append(f)
            elif column in ("rec_no", "rec_type") and known or column and _BYTE.match(column) and known:
                self.wanted.records.append(f)
            elif column == "error" and isinstance(f, D.IsNull):
                self.wanted.without_errors = True
            else:
                yield f

    def _named(self, name: str) -> bool:
        return all(
            f.value == name if isinstance(f, D.EqualTo)
            else name in f.value if isinstance(f, D.In)
            else name.startswith(f.value) if isinstance(f, D.StringStartsWith)
            else True
            for f in self.wanted.names
        )

    def _bounds(self) -> tuple[int, int]:
        """Lowest and highest record number that the filters allow."""
        low, high = 1, 2**62
        for f in self.wanted.records:
            if f.attribute == ("rec_no",) and not isinstance(f, D.IsNotNull):
                values = [v for v in f.value if v is not None] if isinstance(f, D.In) else [f.value]
                if not values:
                    return 1, 0
                if isinstance(f, (D.EqualTo, D.In, D.GreaterThan, D.GreaterThanOrEqual)):
                    low = max(low, min(values) + isinstance(f, D.GreaterThan))
                if isinstance(f, (D.EqualTo, D.In, D.LessThan, D.LessThanOrEqual)):
                    high = min(high, max(values) - isinstance(f, D.LessThan))
        return low, high

    def partitions(self) -> list[Range]:
        layout = LAYOUTS[self.kind]
        files = _listed(self.path, self.kind) if self.path is not None else _tabled(self.files)
        files = [f for f in files if f[0] is not None and self._named(f[0])]
        check_schemes([m.group(1).lower() if (m := re.match("([A-Za-z][A-Za-z0-9+.-]*):", p)) else "" for _, p, _ in files])
        per_split = max(1, self.split_bytes // layout.record_bytes)
        low, high = self._bounds()
        ranges = []
        for name, path, size in files:
            total = max(0, (size - layout.header_bytes) // layout.record_bytes)
            # A file without records is opened as well: it may be gone.
            for first in range((low - 1) // per_split * per_split, max(1, min(total, high)), per_split):
                ranges.append((name, path, first, min(per_split, total - first)))
        each = -(-len(ranges) // MAX_TASKS) or 1
        return [Range(ranges[i : i + each]) for i in range(0, len(ranges), each)] or [Range([])]

    # ---- reading, in tasks

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        layout = LAYOUTS[self.kind]
        kept = np.ones(256, bool)
        kept[list(layout.dropped_types)] = False
        for f in self.wanted.records:
            if f.attribute == ("rec_type",):
                kept &= _holds(f, np.arange(256))
        rest = [f for f in self.wanted.records if f.attribute != ("rec_type",)]
        for name, path, first, n in partition.parts:
            try:
                for start, block in record_blocks(path, layout, first, n):
                    at = np.flatnonzero(kept[block[:, layout.type_byte - 1]])
                    for f in rest:
                        at = at[_holds(f, start + at if f.attribute == ("rec_no",) else block[at, int(f.attribute[0][1:]) - 1])]
                    if len(at):
                        yield self._rows(name, start, block, at, layout.type_byte)
            except Quarantine as error:
                if self.wanted.without_errors:
                    continue
                if "error" not in self.columns or self.wanted.records:
                    raise RuntimeError(f"{path}: {error}") from error
                yield self._failure(name, error)

    def _rows(self, name: str, start: int, block: np.ndarray, at: np.ndarray, type_byte: int) -> pa.RecordBatch:
        made = {
            "pod_file": lambda: pa.repeat(pa.scalar(name, pa.string()), len(at)),
            "rec_no": lambda: pa.array(start + at, pa.int64()),
            "rec_type": lambda: pa.array(block[at, type_byte - 1].astype(np.int32)),
            "error": lambda: pa.nulls(len(at), pa.string()),
        }
        columns = [made[c]() if c in made else pa.array(block[at, int(c[1:]) - 1].astype(np.int32)) for c in self.columns]
        return pa.RecordBatch.from_arrays(columns, self.columns)

    def _failure(self, name: str, error: Exception) -> pa.RecordBatch:
        values = {"pod_file": pa.array([name]), "error": pa.array([str(error)]), "rec_no": pa.nulls(1, pa.int64())}
        return pa.RecordBatch.from_arrays([values.get(c, pa.nulls(1, pa.int32())) for c in self.columns], self.columns)


def _holds(f: D.Filter, values: np.ndarray) -> np.ndarray:
    if isinstance(f, D.IsNotNull):
        return np.ones(len(values), bool)
    if isinstance(f, D.In):
        return np.isin(values, [v for v in f.value if v is not None])
    return _COMPARE[type(f)](values, f.value)


def register(spark: SparkSession) -> SparkSession:
    """Make the format known to a session, with its filters pushed."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(DetectorRecords)
    return spark


def scan(files: DataFrame, kind: str, bytes_wanted: tuple[int, ...] = (), split_bytes: int = SPLIT_BYTES, pushdown: bool = False) -> DataFrame:
    """The given files (pod_file, path, bytes) through the source: pod_file, rec_no, rec_type, b<i> ..., error."""
    spark = register(files.sparkSession)
    columns = ["pod_file string", "rec_no long", "rec_type int", *[f"b{i} int" for i in bytes_wanted], "error string"]
    listed = write_and_name(files.select("pod_file", "path", "bytes"), "scan-files")
    reader = spark.read.format(FORMAT).schema(", ".join(columns)).option("kind", kind)
    return reader.options(files=listed, split_bytes=split_bytes, pushdown=pushdown).load()

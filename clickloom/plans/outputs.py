"""Output tables and their writers.

A set of tables appears as a whole: each is written beside the earlier ones, in a folder of its run, and one small
manifest then names them all. Readers resolve the newest manifest, so a run that breaks between two tables, or
while it writes one, leaves the set before it as it was.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from clickloom.session import at_once, hadoop, remove

TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def deployment_rows(matched: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """Deployments with at least one file, in the given column order."""
    rows = matched.filter((F.col("RowType") == "metadata") & (F.col("MatchCount") > 0))
    return rows.select(*[c for c in order if c in matched.columns])


def _writer(df: DataFrame, fmt: str):
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True).option("timestampNTZFormat", TIME_FORMAT)
    return writer


def _read_back(spark: SparkSession, schema: StructType, path: str, fmt: str) -> DataFrame:
    reader = spark.read.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("timestampNTZFormat", TIME_FORMAT)
    return reader.load(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """Write a table; returns it as written."""
    _writer(df, fmt).save(path)
    return _read_back(df.sparkSession, df.schema, path, fmt)


def write_detections(df: DataFrame, path: str, fmt: str = "parquet", by: str = "filename") -> DataFrame:
    """Detections in one folder per deployment; returns them as written.

    The rebalance keeps the file count low and still cuts a deployment with very many rows into several files.
    """
    _writer(df.hint("rebalance", F.col(by)), fmt).partitionBy(by).save(path)
    return _read_back(df.sparkSession, df.schema, path, fmt)


MANIFESTS = "_published"


def _manifests(spark: SparkSession, out: str) -> list[int]:
    """Numbers of the manifests of a folder, in order."""
    system, folder = hadoop(spark, f"{out}/{MANIFESTS}")
    names = [f.getPath().getName() for f in system.listStatus(folder)] if system.exists(folder) else []
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0].isdigit())


def _publish(spark: SparkSession, out: str, content: dict) -> None:
    """Add a manifest under the next free number. It is written beside and renamed, so no reader sees part of it."""
    system, draft = hadoop(spark, f"{out}/{MANIFESTS}/draft-{uuid.uuid4().hex}")
    sink = system.create(draft, False)
    try:
        sink.write(bytearray(json.dumps(content).encode()))
    finally:
        sink.close()
    number = max(_manifests(spark, out), default=0)
    while True:
        number += 1
        _, name = hadoop(spark, f"{out}/{MANIFESTS}/{number:08d}.json")
        if not system.exists(name) and system.rename(draft, name):
            return


def _manifest(spark: SparkSession, out: str, number: int) -> dict:
    system, name = hadoop(spark, f"{out}/{MANIFESTS}/{number:08d}.json")
    source = system.open(name)
    try:
        return json.loads(bytes(source.readAllBytes()))
    finally:
        source.close()


def publish(spark: SparkSession, out: str, tables: dict[str, DataFrame], fmt: str = "parquet", by: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """Write tables as one set below ``out`` and return them as written. ``by`` names the column a table is parted by."""
    run = f"run-{uuid.uuid4().hex}"
    parted = by or {}

    def job(name: str, table: DataFrame) -> Callable[[], DataFrame]:
        path = f"{out}/{run}/{name}"
        return lambda: write_detections(table, path, fmt, parted[name]) if name in parted else write_table(table, path, fmt)

    done = dict(zip(tables, at_once(*(job(n, t) for n, t in tables.items())), strict=True))
    content = {"run": run, "format": fmt, "tables": {n: json.loads(t.schema.json()) for n, t in tables.items()}}
    _publish(spark, out, content)
    return done


def published(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    """The newest complete set of tables below ``out``; empty if none was published."""
    numbers = _manifests(spark, out)
    if not numbers:
        return {}
    content = _manifest(spark, out, numbers[-1])
    paths = {n: f"{out}/{content['run']}/{n}" for n in content["tables"]}
    return {n: _read_back(spark, StructType.fromJson(s), paths[n], content["format"]) for n, s in content["tables"].items()}


def tidy(spark: SparkSession, out: str, keep: int = 1) -> int:
    """Remove all sets but the last ``keep`` and what broken runs left; returns how many folders went.

    Not while a run writes below ``out``, and not while readers still use an older set.
    """
    numbers = _manifests(spark, out)
    kept, old = (numbers[-keep:], numbers[:-keep]) if keep else ([], numbers)
    runs = {_manifest(spark, out, n)["run"] for n in kept}
    for n in old:  # manifests first: no reader is sent to a folder that is gone
        remove(spark, f"{out}/{MANIFESTS}/{n:08d}.json")
    system, folder = hadoop(spark, out)
    gone = [f.getPath() for f in system.listStatus(folder) if f.getPath().getName().startswith("run-") and f.getPath().getName() not in runs]
    for path in gone:
        system.delete(path, True)
    return len(gone)

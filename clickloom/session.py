"""Session settings, the shared folder for written intermediate tables, and the ledger of a run's finished steps."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from dataclasses import dataclass, field
from threading import Lock
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join partition even where a later step then has to shuffle again.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Windows inside a run of records stay in memory; a run has at most this many rows.
    "spark.sql.windowExec.buffer.in.memory.threshold": "65536",
    # Filters reach the reader of detector files.
    "spark.sql.python.filterPushdown.enabled": "true",
}

T = TypeVar("T")
# Small independent jobs submitted at the same time.
PARALLEL_JOBS = 4



@dataclass
class _Run:
    """The run that is going on: its folder, and the steps it has taken."""

    folder: str
    steps: set[str] = field(default_factory=set)
    lock: Lock = field(default_factory=Lock)


_run: ContextVar[_Run | None] = ContextVar("run", default=None)


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir`` or ``setCheckpointDir``."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return folder.rstrip("/")


def new_folder(spark: SparkSession, label: str, kept: bool = False) -> str:
    """A folder below the shared one. It goes with the run that is going on, unless it is to be ``kept``."""
    run = None if kept else _run.get()
    return f"{run.folder if run else shared_folder(spark) + '/clickloom'}/{label}-{uuid.uuid4().hex}"


def hadoop(spark: SparkSession, path: str):
    """File system of a path, and the path as it knows it."""
    name = spark._jvm.org.apache.hadoop.fs.Path(path)
    return name.getFileSystem(spark._jsc.hadoopConfiguration()), name


def exists(spark: SparkSession, path: str) -> bool:
    system, name = hadoop(spark, path)
    return system.exists(name)


def remove(spark: SparkSession, path: str) -> None:
    system, name = hadoop(spark, path)
    system.delete(name, True)


@contextmanager
def scratch(spark: SparkSession, label: str, key: str | None = None) -> Iterator[str]:
    """A folder for the intermediate tables of a run, removed at its end.

    With ``key``, which has to stand for everything that the run reads and for its parameters, the folder outlives a run
    that fails, and a second start goes on with the steps that were finished (see :func:`step`). Two runs of one key must not go
    on at the same time.
    """
    folder = new_folder(spark, label) if key is None else f"{shared_folder(spark)}/clickloom/{label}-{key}"
    token = _run.set(_Run(folder))
    try:
        yield folder
        failed = False
    except BaseException:
        failed = True
        raise
    finally:
        _run.reset(token)
        if key is None or not failed:
            remove(spark, folder)


def step(spark: SparkSession, label: str, make: Callable[[], DataFrame]) -> DataFrame:
    """A written table that a run makes once: read again if an earlier start of the same run finished it.

    The mark of success that Spark writes last is the entry in the ledger; what a broken start left half done is
    overwritten. Inside a run each label stands for one table. Outside of one this is :func:`write_and_read`.
    """
    run = _run.get()
    if run is None:
        return write_and_read(make(), label)
    with run.lock:
        if label in run.steps:
            raise ValueError(f"a run has one step {label!r}")
        run.steps.add(label)
    folder = f"{run.folder}/steps/{label}"
    if not exists(spark, f"{folder}/_SUCCESS"):
        make().write.mode("overwrite").parquet(folder)
    return spark.read.parquet(folder)


def write_and_name(df: DataFrame, label: str) -> str:
    """Write ``df`` once to the shared folder; the name of its folder."""
    folder = new_folder(df.sparkSession, label)
    df.write.parquet(folder)
    return folder


def write_and_read(df: DataFrame, label: str) -> DataFrame:
    """Cut lineage: write ``df`` once to the shared folder and continue from the written table."""
    return df.sparkSession.read.schema(df.schema).parquet(write_and_name(df, label))


def at_once(*jobs: Callable[[], T]) -> list[T]:
    """Run independent Spark jobs side by side; results in the given order."""
    with ThreadPoolExecutor(PARALLEL_JOBS) as pool:
        return [f.result() for f in [pool.submit(copy_context().run, job) for job in jobs]]

"""Shared pieces of the operators: reading, registration, written intermediate tables, ASCII rules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickloom.session import write_and_read

__all__ = ["ORACLES", "QUERIES", "ascii_lower", "documents", "read", "register", "small", "tuned", "write_and_read"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# One Arrow batch: so many rows of ordinary texts, fewer of very long ones.
BATCH_ROWS, BATCH_BYTES = 500, 2 << 20
# A side with more rows than this is never hinted for broadcast.
BROADCAST_ROWS = 50_000

WHITE = " \t\n\x0b\x0c\r"  # the characters of [\x20\x09-\x0D]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def register(name: str, sql: str | None = None):
    """Register ``(spark, sf_dir) -> DataFrame`` as a query, with DuckDB SQL where SQL can express it."""

    def add(run):
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return add


def tuned(spark: SparkSession) -> SparkSession:
    """Small Arrow batches, so that a task's memory follows a few documents and not thousands."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return tuned(spark).read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents")


def small(df: DataFrame) -> DataFrame:
    """Hint a written table for broadcast if its rows are counted to be few; else leave the join as it is."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else; ``lower`` does the same where every character is one byte."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))

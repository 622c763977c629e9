"""Collects the registered queries with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
TWINS: dict[str, str] = {}


def query(name: str, sql: str | None = None, gaps: tuple[str, ...] = ()):
    """Register a callable ``(spark, sf_dir) -> DataFrame`` and, where one exists, its SQL twin.

    ``gaps`` names whole-number columns that may be NULL. Both sides return them as doubles, because
    data frames of different engines disagree on the type of such a column.
    """

    def add(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")

        def widened(spark: SparkSession, sf: str) -> DataFrame:
            return run(spark, sf).withColumns({c: F.col(c).cast("double") for c in gaps})

        QUERIES[name] = widened if gaps else run
        if sql is not None:
            casts = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in gaps)
            TWINS[name] = f"SELECT * REPLACE ({casts}) FROM (\n{sql}\n) w" if gaps else sql
        return run

    return add

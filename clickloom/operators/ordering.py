"""Row order over groups of any size.

A window over a whole recorder file puts that file into one task. The helpers here work on
fixed-size runs of record numbers instead: one window inside each run, and one over the table
of per-run totals, which has one row for every ``run_rows`` records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from clickloom.session import write_and_read

RUN_ROWS = 65_536


def with_run(df: DataFrame, order: str = "rec_no", run_rows: int = RUN_ROWS) -> DataFrame:
    """Add the run of each row. A ``run`` column already there is kept, and with it the partitioning by it."""
    if "run" in df.columns:
        return df
    return df.withColumn("run", F.expr(f"{order} div {run_rows}"))


def earlier_runs(keys: list[str]):
    """Frame over the runs of a group that lie before the current one."""
    return W.partitionBy(*keys).orderBy("run").rowsBetween(W.unboundedPreceding, -1)


def _from_placed(placed: DataFrame, keys: list[str], out: str) -> DataFrame:
    """Row numbers from a written table whose ``_at`` column holds partition index and row index."""
    placed = placed.withColumn("run", F.shiftright("_at", 33))
    starts = placed.groupBy(*keys, "run").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    starts = starts.select(
        *keys, "run", "_first", F.coalesce(F.sum("_n").over(earlier_runs(keys)), F.lit(0)).alias("_before")
    )
    return (
        placed.join(starts, [*keys, "run"])
        .withColumn(out, F.col("_at") - F.col("_first") + F.col("_before") + 1)
        .drop("_at", "_first", "_before", "run")
    )


def number_rows(df: DataFrame, keys: list[str], order: list[str], out: str = "rec_no") -> DataFrame:
    """Number the rows of each group from 1 in ``order``, which must end in a unique column.

    Range partitioning on group and order cuts a hot group into many partitions; the sorted rows
    are written once, so the partition index stays fixed for the second step.
    """
    ranged = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    placed = write_and_read(ranged.withColumn("_at", F.monotonically_increasing_id()), "numbered")
    return _from_placed(placed, keys, out)


def number_as_read(df: DataFrame, columns: list[str], out: str = "row_no") -> DataFrame:
    """Number rows from 1 by path, place in the file, and order of reading.

    Spark deals parts of files to partitions by their size, so partitions do not follow the order of files. Rows of one
    part are read in order; the parts are ordered by path and start. ``df`` is a file source; the table of parts has
    one row for each.
    """
    part = ["_path", "_start"]
    placed = df.select(
        *[F.col(f"`{c}`") for c in columns],
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_at"),
    )
    placed = write_and_read(placed, "read")
    starts = placed.groupBy(*part).agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    before = F.sum("_n").over(W.orderBy(*part).rowsBetween(W.unboundedPreceding, -1))
    starts = starts.select(*part, "_first", F.coalesce(before, F.lit(0)).alias("_before"))
    return (
        placed.join(starts, part)
        .withColumn(out, F.col("_at") - F.col("_first") + F.col("_before") + 1)
        .drop("_at", "_first", "_before", *part)
    )


def number_in_groups(
    df: DataFrame, keys: list[str], order: str = "rec_no", out: str = "pos", run_rows: int = RUN_ROWS
) -> DataFrame:
    """Number rows from 1 inside ``keys`` by a record number that is already dense in the file."""
    runs = with_run(df, order, run_rows)
    totals = runs.groupBy(*keys, "run").agg(F.count("*").alias("_n"))
    offsets = totals.select(
        *keys, "run", F.coalesce(F.sum("_n").over(earlier_runs(keys)), F.lit(0)).alias("_before")
    )
    inside = W.partitionBy(*keys, "run").orderBy(order)
    return (
        runs.withColumn("_at", F.row_number().over(inside))
        .join(offsets, [*keys, "run"])
        .withColumn(out, F.col("_at") + F.col("_before"))
        .drop("_at", "_before", "run")
    )


def first_row(keys: list[str], order: list[Column], df: DataFrame) -> DataFrame:
    """Keep the first row of each group by ``order``: an aggregate, so hot groups combine map-side."""
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
        .select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])
        .select(*df.columns)
    )

"""Exact top-k inner products with a vector-approximation file.

Every component x becomes floor(256 x). Each dimension is cut into at most 256 cells at quantiles of a bounded sample; the
outermost cells reach to the least and largest value of all vectors. The approximation file is a table of its own
with one byte a component. First scan of it: cells give a lower and an upper bound of each score, and the k-th largest
lower bound of a query over all vectors is a score that its k-th result reaches at least. Second scan: vectors whose
upper bound reaches it are noted as (query, vector, bound). Exact vectors are then fetched by joins on these
pairs alone, by falling upper bound: first those at the head of each query's list, whose exact scores give a higher
floor, then the rest of the list as far as its bounds still reach that floor. No other exact vector is read.

Vectors stay in their partitions. Queries go to the tasks in blocks of at most ``QUERY_BYTES``, numbered without gaps, so
a block is one interval of numbers. The cells are fitted on a sample of about ``SAMPLE_VALUES`` components of each
length; the sample decides how many vectors are read, never what is returned.

Scores are exact whatever the size of components: sums that stay below 2^53 are added as doubles, which is exact,
all others as Python integers. A score beyond the range of a long is ranked by its value and returned as the end of the range.

Edge cases: vectors that are null, empty, or hold null or non-finite components (also after scaling) take no part, nor do rows without an id, since
a result could not name them. Vectors of another length than the query's are no candidates. Every row but the query's
own is a candidate, also under the same id; rows repeated under one id in the query set are one query each. Ties go to the
smaller id. An empty table gives an empty result. Only the id and the vector are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from clickloom.llm.common import read, register, small, write_and_read
from clickloom.operators.ordering import number_rows

SCALE = 256
CELLS = 256
K = 5
EVERY = 50
SAMPLE_VALUES = 1 << 20  # components, of vectors of one length
QUERY_BYTES = 32 << 20
DATA_BLOCK = 2048
TILE = 512  # queries whose bounds are in memory at once
HEAD = 4  # times k: exact vectors a query reads before its floor is raised
EXACT = 2.0**53
LARGEST = 10**308  # a score that a double holds

Blocks = Iterator[pa.RecordBatch]


def scaled(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, v): the whole-numbered vectors of the rows that take part, as doubles."""
    raw = vectors.select(F.col(id_col).alias("vec_id"), F.col(vec_col).cast("array<double>").alias("x"))
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c * SCALE) < float("inf"))
    whole = (F.size("x") > 0) & F.forall("x", finite)
    # ``floor`` would give a long, which large components do not fit; beyond 2^53 doubles are whole anyway.
    floor = lambda c: F.when(F.abs(c) < EXACT, F.floor(F.when(F.abs(c) < EXACT, c)).cast("double")).otherwise(c)
    ints = F.transform("x", lambda c: floor(c * SCALE))
    return raw.filter(F.col("vec_id").isNotNull() & F.coalesce(whole, F.lit(False))).select("vec_id", ints.alias("v"))


def _by_length(batch: pa.RecordBatch, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, matrix) of a list or binary column, a block of rows at a time."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if pa.types.is_binary(column.type):
        values = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    else:
        values = column.values.to_numpy(zero_copy_only=False)
    sizes = np.diff(offsets)
    for d in np.unique(sizes):
        at = np.flatnonzero(sizes == d)
        for part in np.array_split(at, max(1, -(-len(at) // DATA_BLOCK))):
            yield int(d), part, values[offsets[part][:, None] + np.arange(d)]


class Cells:
    """Edges of the cells of each dimension, for vectors of one length."""

    def __init__(self, sample: np.ndarray, least: np.ndarray, most: np.ndarray):
        share = np.linspace(0, 1, CELLS + 1)[1:-1]
        self.inner = np.quantile(sample, share, axis=0, method="lower").T  # dimension x inner edges
        self.least, self.most = least, most

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """The cell of each component: how many inner edges it reaches."""
        return np.stack([np.searchsorted(e, vectors[:, i], "right") for i, e in enumerate(self.inner)], axis=1).astype(np.uint8)

    def corners(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest value that a component of this cell has; components are whole numbers."""
        n = self.inner.shape[1]
        low = np.concatenate([self.least[:, None], np.maximum(self.inner, self.least[:, None])], axis=1)
        high = np.concatenate([np.where(np.abs(self.inner) < EXACT, self.inner - 1, self.inner), self.most[:, None]], axis=1)
        which = np.arange(codes.shape[1]) * (n + 1) + codes
        return low.ravel()[which], np.maximum(high.ravel()[which], low.ravel()[which])


def fit(vectors: DataFrame) -> dict[int, Cells]:
    """Cells of each vector length: quantiles of a bounded sample, ends of all vectors."""
    sized = vectors.withColumn("d", F.size("v"))

    def ends(batches: Blocks) -> Blocks:
        found: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for d, _, m in _by_length(batch, batch.column(0)):
                low, high = found.get(d, (m[0], m[0]))
                found[d] = [np.minimum(low, m.min(axis=0)), np.maximum(high, m.max(axis=0))]
        for d, (low, high) in found.items():
            yield pa.RecordBatch.from_pydict({"d": np.full(d, d), "i": np.arange(d), "low": low, "high": high})

    limits = vectors.select("v").mapInArrow(ends, "d long, i long, low double, high double")
    limits = limits.groupBy("d", "i").agg(F.min("low").alias("low"), F.max("high").alias("high")).orderBy("d", "i").collect()
    # One vector in so many by a hash of its number, and of these no more than wanted.
    wanted = F.greatest(F.lit(CELLS), F.floor(F.lit(SAMPLE_VALUES) / F.col("d")))
    every = small(write_and_read(sized.groupBy("d").agg(F.count("*").alias("n")), "va-lengths"))
    every = every.select("d", wanted.alias("wanted"), F.greatest(F.lit(1), F.floor(F.col("n") / wanted)).alias("every"))
    few = sized.join(every, "d").filter(F.pmod(F.xxhash64("row"), F.col("every")) == 0)
    order = W.partitionBy("d").orderBy(F.xxhash64("row", F.lit(1)), "row")
    few = few.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= F.col("wanted"))
    rows: dict[int, list] = {}
    for r in few.select("d", "v").toLocalIterator():
        rows.setdefault(r["d"], []).append(np.array(r["v"]))
    made = {}
    for d, some in rows.items():
        low, high = (np.array([r[c] for r in limits if r["d"] == d]) for c in ("low", "high"))
        made[d] = Cells(np.array(some), low, high)
    return made


def approximation(vectors: DataFrame, cells: dict[int, Cells]) -> DataFrame:
    """The approximation file: (row, cells), one byte a component."""

    def run(batches: Blocks) -> Blocks:
        for batch in batches:
            rows = batch.column(0).to_numpy()
            for d, at, m in _by_length(batch, batch.column(1)):
                codes = cells[d].codes(m)
                yield pa.RecordBatch.from_pydict({"row": rows[at], "cells": pa.array([c.tobytes() for c in codes], pa.binary())})

    return vectors.select("row", "v").mapInArrow(run, "row long, cells binary")


class QueryBlock:
    """Queries of one length: exact vectors and the numbers of their rows."""

    def __init__(self, rows: np.ndarray, v: np.ndarray):
        self.row, self.v = rows, v

    def tiles(self) -> Iterator[QueryBlock]:
        for i in range(0, len(self.row), TILE):
            yield QueryBlock(self.row[i : i + TILE], self.v[i : i + TILE])

    def bounds(self, low: np.ndarray, high: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of all scores, minus infinity for a query's own row."""
        up, down = np.maximum(self.v, 0), np.minimum(self.v, 0)
        # Sums of d products round by less than d units of 2**-52 of the sum of their sizes.
        with np.errstate(over="ignore", invalid="ignore"):
            slack = np.abs(self.v) @ np.maximum(np.abs(low), np.abs(high)).max(axis=0) * (low.shape[1] + 2) * 2.0**-51
            lower = up @ low.T + down @ high.T - slack[:, None]
            upper = up @ high.T + down @ low.T + slack[:, None]
        # Where sums leave the range of doubles nothing is known.
        lower[~np.isfinite(lower)] = -np.finfo(float).max
        upper[~np.isfinite(upper)] = np.finfo(float).max
        own = self.row[:, None] == rows[None, :]
        lower[own], upper[own] = -np.inf, -np.inf
        return lower, upper


def _best(values: np.ndarray, k: int) -> np.ndarray:
    """The k largest values of each row, in any order."""
    return values if values.shape[1] <= k else np.partition(values, values.shape[1] - k, axis=1)[:, -k:]


def _floors(queries: dict[int, QueryBlock], cells: dict[int, Cells], k: int):
    """First scan: the k largest lower bounds of each query over the vectors of a task."""

    def run(batches: Blocks) -> Blocks:
        found = {d: np.full((len(q.row), k), -np.inf) for d, q in queries.items()}
        for batch in batches:
            rows = batch.column(0).to_numpy()
            for d, at, codes in _by_length(batch, batch.column(1)):
                block = queries.get(d)
                corners = cells[d].corners(codes) if block else ()
                for i, tile in enumerate(block.tiles()) if block else ():
                    lower, _ = tile.bounds(*corners, rows[at])
                    part = slice(i * TILE, i * TILE + len(tile.row))
                    found[d][part] = _best(np.hstack([found[d][part], _best(lower, k)]), k)
        for d, kept in found.items():
            number, at = np.nonzero(np.isfinite(kept))
            yield pa.RecordBatch.from_pydict({"query": queries[d].row[number], "bound": kept[number, at]})

    return run


def _near(queries: dict[int, QueryBlock], cells: dict[int, Cells], floors: dict[int, float]):
    """Second scan: the pairs whose upper bound reaches the query's floor."""

    def run(batches: Blocks) -> Blocks:
        for batch in batches:
            rows = batch.column(0).to_numpy()
            for d, at, codes in _by_length(batch, batch.column(1)):
                block = queries.get(d)
                corners = cells[d].corners(codes) if block else ()
                for tile in block.tiles() if block else ():
                    _, upper = tile.bounds(*corners, rows[at])
                    least = np.array([floors.get(n, -np.inf) for n in tile.row.tolist()])
                    q, v = np.nonzero(np.isfinite(upper) & (upper >= least[:, None]))
                    if len(q):
                        yield pa.RecordBatch.from_pydict({"query": tile.row[q], "row": rows[at][v], "upper": upper[q, v]})

    return run


def products(a: np.ndarray, b: np.ndarray) -> list[int]:
    """Exact inner products of the rows of two matrices of whole numbers."""
    with np.errstate(over="ignore", invalid="ignore"):
        safe = (np.abs(a) * np.abs(b)).sum(axis=1) < EXACT / 2
        sums = np.where(safe, (a * b).sum(axis=1), 0)
    out = [int(s) for s in sums.tolist()]
    for i in np.flatnonzero(~safe):
        out[i] = sum(int(x) * int(y) for x, y in zip(a[i].tolist(), b[i].tolist(), strict=True))
    return out


def _scores(batches: Blocks) -> Blocks:
    """Exact scores of pairs that carry both vectors: as a long, as a double, and as text that sorts scores of any size."""
    for batch in batches:
        score = [0] * len(batch)
        b = batch.column(4).values.to_numpy(zero_copy_only=False)
        starts = batch.column(4).offsets.to_numpy().astype(np.int64)
        for d, at, a in _by_length(batch, batch.column(3)):
            for i, s in zip(at.tolist(), products(a, b[starts[at][:, None] + np.arange(d)]), strict=True):
                score[i] = s
        held = pa.array([max(-(2**63), min(2**63 - 1, s)) for s in score], pa.int64())
        value = pa.array([float(max(-LARGEST, min(LARGEST, s))) for s in score], pa.float64())
        order = pa.array([ranked(s) for s in score], pa.string())
        yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), held, value, order], ["query", "row", "vec_id", "score", "value", "order"])


def ranked(score: int) -> str:
    """Text that sorts as the number does: sign, number of digits, digits (turned for negative numbers)."""
    digits = str(abs(score))
    if score >= 0:
        return f"1{len(digits):04d}{digits}"
    return f"0{9999 - len(digits):04d}{digits.translate(_TURNED)}"


_TURNED = str.maketrans("0123456789", "9876543210")


def _fetched(pairs: DataFrame, vectors: DataFrame, queries: DataFrame) -> DataFrame:
    """Exact scores of pairs (query, row)."""
    asked = queries.select(F.col("row").alias("query"), F.col("v").alias("q"))
    both = pairs.select("query", "row").join(vectors.select("row", "vec_id", "v"), "row").join(asked, "query")
    return both.select("query", "row", "vec_id", "v", "q").mapInArrow(_scores, "query long, row long, vec_id long, score long, value double, order string")


def _block(queries: DataFrame, low: int, high: int) -> dict[int, QueryBlock]:
    """The queries of one block on the driver: at most ``QUERY_BYTES``."""
    found: dict[int, list] = {}
    for r in queries.filter(F.col("number").between(low, high)).select("row", "v").toLocalIterator():
        found.setdefault(len(r["v"]), []).append((r["row"], np.array(r["v"])))
    return {d: QueryBlock(np.array([r for r, _ in rows]), np.stack([v for _, v in rows])) for d, rows in found.items()}


def top_k(vectors: DataFrame, every: int = EVERY, k: int = K, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """(query_id, rank, vec_id, score) of the rows whose id ``every`` divides against all rows of ``vectors`` (as from ``scaled``)."""
    spark = vectors.sparkSession
    # One number a row, fixed once written.
    stored = write_and_read(vectors.select(F.monotonically_increasing_id().alias("row"), "vec_id", "v"), "va-vectors")
    asked = stored.filter(F.col("vec_id") % every == 0)
    asked = write_and_read(number_rows(asked, [], ["row"], out="number"), "va-queries")
    facts = asked.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("d")).first()
    cells = fit(stored)
    cut = write_and_read(approximation(stored, cells), "va-cells")
    step = max(1, query_bytes // (8 * facts["d"])) if facts["n"] else 1
    out = []
    for first in range(1, facts["n"] + 1, step):
        block = _block(asked, first, first + step - 1)
        bounds = cut.mapInArrow(_floors(block, cells, k), "query long, bound double")
        last = W.partitionBy("query").orderBy(F.desc("bound"))
        kth = bounds.withColumn("n", F.row_number().over(last)).filter(F.col("n") == k).select("query", "bound")
        floors = {r["query"]: r["bound"] for r in kth.collect()}  # one number a query of the block
        out.append(write_and_read(cut.mapInArrow(_near(block, cells, floors), "query long, row long, upper double"), "va-near"))
    near = out[0] if out else spark.createDataFrame([], "query long, row long, upper double")
    for more in out[1:]:
        near = near.unionByName(more)
    # The head of each list first; then what its k-th exact score leaves of the rest.
    falling = W.partitionBy("query").orderBy(F.desc("upper"), "row")
    head = near.withColumn("place", F.row_number().over(falling)).filter(F.col("place") <= HEAD * k).drop("place")
    head = write_and_read(_fetched(head, stored, asked), "va-head")
    best = W.partitionBy("query").orderBy(F.desc("order"), "vec_id", "row")
    kth = head.withColumn("n", F.row_number().over(best)).filter(F.col("n") == k)
    kth = kth.select("query", (F.col("value") - F.abs("value") * 2.0**-50).alias("floor"))
    rest = near.join(kth, "query").filter(F.col("upper") >= F.col("floor")).join(head.select("query", "row"), ["query", "row"], "left_anti")
    found = head.unionByName(_fetched(rest, stored, asked))
    results = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    ids = asked.select(F.col("row").alias("query"), F.col("vec_id").alias("query_id"))
    return results.join(ids, "query").select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


ORACLE = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS HUGEINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.r AS q, q.vec_id AS query_id, c.r, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.r <> q.r AND len(c.v) = len(q.v)),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, vec_id, r) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, CAST(greatest(least(score, 9223372036854775807), -9223372036854775808) AS BIGINT) AS score FROM r WHERE rank <= 5
"""


@register("op8_va_file_top_k", ORACLE)
def op8_va_file_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(scaled(read(spark, sf_dir, "embeddings")))

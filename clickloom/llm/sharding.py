"""Sharding by a k-d tree over document metadata.

A node that holds ``k`` shards is cut along the dimension in which its documents spread most (range over the
range of the whole table) at the weighted quantile ``floor(k / 2) / k`` of bytes, until each node is one shard
of the target bytes. All nodes of a level are cut at once. The quantile comes from histograms of 1,024 buckets: one of
the coordinate, then, inside the bucket of the cut, three of the bits of a hash of the text. Documents with equal
texts have the metadata of the first of them, so a cut parts no group of copies, unless the group that it falls on
weighs more than ``WHOLE_GROUP`` of a shard; then a histogram of a hash of the id parts the group. What reaches the
driver is one row per node.

Slots: documents of a shard are ordered by the hash of the id. Shards are cut into ranges of this hash, so no
window runs over a whole shard.

Edge cases: null or empty text has 1 byte of size and CRC-32 0; null metadata is the lowest coordinate; equal rows
are separate documents that no histogram can part; an empty table gives an empty result. Only the named columns are
read, so further ones may have any name.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from clickloom.llm.common import documents, register, write_and_read

BINS = 1024
LEVELS = 5  # histograms of one cut: coordinate, three times ten bits of the text's hash, the id's hash
WHOLE_GROUP = 1 / 16
SLOT_ROWS = 20_000
MAX_SHARDS = 4096  # nodes of one level, which the driver holds


def _prefix_number(text: Column) -> Column:
    """First six bytes as a number: same order as the strings, as far as six bytes go."""
    padded = F.rpad(F.hex(F.substring(text.cast("binary"), 1, 6)), 12, "0")
    return F.coalesce(F.conv(padded, 16, 10).cast("double"), F.lit(-1.0))


def metadata(docs: DataFrame) -> DataFrame:
    """One narrow row per document: size, checksum, coordinates and the two hashes that break ties."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        _prefix_number(F.col("source")).alias("source"),
        _prefix_number(F.col("lang")).alias("lang"),
        F.xxhash64(F.lit(1), text).alias("h1"),
        F.xxhash64(F.lit(2), F.col("doc_id")).alias("h2"),
    )
    rows = write_and_read(rows, "kd-rows")
    shared = rows.groupBy("h1").agg(
        F.struct(
            F.log2(F.first("size").cast("double")).alias("d0"),
            F.min("source").alias("d1"),
            F.min("lang").alias("d2"),
            F.coalesce(F.min("doc_id").cast("double"), F.lit(-1.0)).alias("d3"),
        ).alias("at")
    )
    placed = rows.drop("source", "lang").join(shared, "h1")
    return placed.select("doc_id", "size", "text_crc32", "h1", "h2", F.array(*[F.col(f"at.d{i}") for i in range(DIMS)]).alias("at"), F.lit(0).alias("node"))


DIMS = 4
_CUT = [f"c{i}" for i in range(LEVELS)]


def _ten_bits(h: Column, at: int) -> Column:
    return F.shiftrightunsigned(h, 54 - 10 * at).bitwiseAND(F.lit(1023)).cast("int")


def _with_cuts(nodes: DataFrame, cuts: list[tuple]) -> DataFrame:
    """Join the cuts of one level: at most MAX_SHARDS rows."""
    spark = nodes.sparkSession
    schema = "node int, dim int, low double, width double, " + ", ".join(f"{c} int" for c in _CUT)
    return nodes.join(F.broadcast(spark.createDataFrame(cuts, schema)), "node")


def _bins() -> list[Column]:
    scaled = F.try_divide(F.element_at("at", F.col("dim") + 1) - F.col("low"), F.col("width")) * BINS
    coordinate = F.when(F.col("width") > 0, F.least(F.floor(scaled), F.lit(BINS - 1))).otherwise(0).cast("int")
    return [coordinate, *[_ten_bits(F.col("h1"), i) for i in range(LEVELS - 2)], _ten_bits(F.col("h2"), 0)]


def _children(nodes: DataFrame, cuts: list[tuple]) -> DataFrame:
    """Node numbers of the next level: below the cut 2 n, from it on 2 n + 1."""
    key = F.struct(*[b.alias(f"k{i}") for i, b in enumerate(_bins())])
    cut = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(_CUT)])
    side = F.when(key < cut, 0).otherwise(1)
    return _with_cuts(nodes, cuts).withColumn("node", F.col("node") * 2 + side).drop("dim", "low", "width", *_CUT)


def _level(nodes: DataFrame, shards: dict[int, int], spread: list[float] | None) -> tuple[list[tuple], list[float]]:
    """Cuts of the nodes that hold more than one shard."""
    aggs = [F.sum("size").alias("size")]
    for d in range(DIMS):
        aggs += [F.min(F.element_at("at", d + 1)).alias(f"l{d}"), F.max(F.element_at("at", d + 1)).alias(f"u{d}")]
    stats = nodes.groupBy("node").agg(*aggs).collect()
    if spread is None:
        spread = [max((r[f"u{d}"] - r[f"l{d}"] for r in stats), default=0.0) for d in range(DIMS)]
    cuts, goal, share = {}, {}, {}
    for r in stats:
        k = shards[r["node"]]
        if k < 2:
            cuts[r["node"]] = [r["node"], 0, 0.0, 0.0, BINS, 0, 0, 0, 0]  # all stays below
            continue
        widths = [(r[f"u{d}"] - r[f"l{d}"]) / spread[d] if spread[d] > 0 else 0.0 for d in range(DIMS)]
        d = max(range(DIMS), key=lambda d: widths[d])
        cuts[r["node"]] = [r["node"], d, r[f"l{d}"], r[f"u{d}"] - r[f"l{d}"], *[0] * LEVELS]
        goal[r["node"]], share[r["node"]] = r["size"] * (k // 2) / k, r["size"] / k
    before, cell = dict.fromkeys(goal, 0), dict.fromkeys(goal, 0)
    open_ = set(goal)
    for depth in range(LEVELS):
        if depth == LEVELS - 1:  # the cell is one group of copies, or very few texts
            open_ = {n for n in open_ if cell[n] > WHOLE_GROUP * share[n]}
        if not open_:
            break
        known, bins = _with_cuts(nodes, [tuple(cuts[n]) for n in open_]), _bins()
        for i in range(depth):
            known = known.filter(bins[i] == F.col(f"c{i}"))
        sums = known.groupBy("node", bins[depth].alias("bin")).agg(F.sum("size").alias("size"))
        bounds = known.sparkSession.createDataFrame([(n, float(goal[n] - before[n])) for n in open_], "node int, goal double")
        order = W.partitionBy("node").orderBy("bin")
        upto = sums.withColumn("upto", F.sum("size").over(order)).withColumn("most", F.max("bin").over(W.partitionBy("node")))
        at = (F.col("upto") >= F.col("goal")) | (F.col("bin") == F.col("most"))
        found = upto.join(F.broadcast(bounds), "node").filter(at).groupBy("node").agg(F.min(F.struct("bin", "upto", "size")).alias("f"))
        for r in found.collect():
            n, f = r["node"], r["f"]
            cuts[n][4 + depth] = f["bin"]
            before[n], cell[n] = before[n] + f["upto"] - f["size"], f["size"]
    for n in goal:
        # The last cell goes to the nearer side as a whole.
        below = abs(before[n] + cell[n] - goal[n]) < abs(goal[n] - before[n])
        last = cuts[n][4 + LEVELS - 1] if n in open_ else 0
        cuts[n][4 + LEVELS - 1] = (last + 1 if n in open_ else BINS) if below else last
    return [tuple(c) for c in cuts.values()], spread


def shard(docs: DataFrame, target_bytes: int | None = None, shards: int | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot); give the number of shards or the bytes one is to reach."""
    narrow = write_and_read(metadata(docs), "kd-metadata")
    total = narrow.agg(F.sum("size").alias("b"), F.count("*").alias("n")).first()
    if shards is None:
        shards = max(1, math.ceil((total["b"] or 0) / target_bytes))
    if shards > MAX_SHARDS:
        raise ValueError(f"{shards} shards; this tree holds at most {MAX_SHARDS}, use larger targets")
    nodes, held, spread = narrow, {0: shards}, None
    while total["n"] and max(held.values()) > 1:
        cuts, spread = _level(nodes, held, spread)
        nodes = _children(nodes, cuts)
        held = {c: k for n, k0 in held.items() for c, k in ((2 * n, k0 // 2 if k0 > 1 else k0), (2 * n + 1, k0 - k0 // 2 if k0 > 1 else 0))}
        held = {n: k for n, k in held.items() if k}
    numbers = narrow.sparkSession.createDataFrame([(n, i) for i, n in enumerate(sorted(held))], "node int, shard int")
    placed = nodes.join(F.broadcast(numbers), "node")
    return _with_slots(placed, shards, total["n"]).select("doc_id", "size", "text_crc32", "shard", "slot")


def _with_slots(placed: DataFrame, shards: int, rows: int) -> DataFrame:
    """Number the rows of each shard from 0 in the order of the id's hash, range by range."""
    bits = max(0, min(16, math.ceil(math.log2(max(1, rows / shards / SLOT_ROWS)))))
    ranges = F.shiftrightunsigned("h2", 64 - bits).cast("int") if bits else F.lit(0)
    placed = placed.withColumn("range", ranges)
    before = W.partitionBy("shard").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    starts = placed.groupBy("shard", "range").agg(F.count("*").alias("n"))
    starts = starts.select("shard", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = W.partitionBy("shard", "range").orderBy("h2", "doc_id", "h1")
    numbered = placed.withColumn("slot", F.row_number().over(inside) - 1)
    return numbered.join(starts, ["shard", "range"]).withColumn("slot", (F.col("slot") + F.col("start")).cast("long"))


@register("op2_kd_tree_shards")
def op2_kd_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard(documents(spark, sf_dir), shards=16)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )

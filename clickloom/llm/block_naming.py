"""Exact deduplication by deterministic block naming.

A text is cut into blocks of 4,096 bytes. The distinct blocks are sorted and named by integers. Then adjacent
names are paired, the distinct pairs are sorted and named in turn, and so on, until every document has one
name. Names are equal exactly when the blocks below them are, so (number of levels, name) identifies a text
without any chance of a collision.

A block travels once, to be compared and named. Its name finds the way back by a 128-bit key of the block; the
names table shows whether two different blocks share a key, and then naming starts again with other keys, so
the key decides nothing.

Of equal texts the row with the largest ``doc_id`` stays (null ids come first, so they stay only if all are
null); of several rows with that id one stays.

Edge cases: null counts as empty, an empty text is one empty block; long texts take more levels; repeated rows
are separate members of a group; an empty table gives an empty result. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickloom.llm.common import documents, register, write_and_read

BLOCK_BYTES = 4096
KEY_TRIES = 8

BlockKey = Callable[[Column, int], list[Column]]


def hash_key(block: Column, attempt: int) -> list[Column]:
    return [F.xxhash64(F.lit(2 * attempt), block), F.xxhash64(F.lit(2 * attempt + 1), block)]


def _raw(docs: DataFrame) -> DataFrame:
    """Texts as bytes, converted once: a cut out of bytes costs only the cut."""
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("raw"))


def _blocks(raw: Column) -> Column:
    """Fixed-size blocks of the bytes of a text, at least one."""
    count = F.greatest(F.ceil(F.octet_length(raw) / BLOCK_BYTES), F.lit(1)).cast("int")
    return F.transform(
        F.sequence(F.lit(0), count - 1), lambda i: F.substring(raw, i * BLOCK_BYTES + 1, F.lit(BLOCK_BYTES))
    )


def _named(keys: DataFrame, by: list[str], label: str) -> DataFrame:
    """Sort the distinct rows and give each an integer; written, so that a name never changes."""
    return write_and_read(
        keys.groupBy(*by).agg(F.lit(0).alias("_")).drop("_").sortWithinPartitions(*by).withColumn("name", F.monotonically_increasing_id()),
        label,
    )


def _block_names(docs: DataFrame, key: BlockKey, attempt: int) -> tuple[DataFrame, DataFrame]:
    """Rows with the keys of their blocks, and the name of each key."""
    blocks = F.col("blocks")
    cut = _raw(docs).select("doc_id", "raw", _blocks(F.col("raw")).alias("blocks"))
    rows = cut.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.sha2("raw", 256).alias("text_sha256"),
        F.transform(blocks, lambda b: F.struct(*[k.alias(f"k{i}") for i, k in enumerate(key(b, attempt))])).alias("keys"),
    )
    rows = write_and_read(rows, "naming-rows")
    single = _raw(docs).select(F.explode(_blocks(F.col("raw"))).alias("block"))
    single = single.select("block", *[k.alias(f"k{i}") for i, k in enumerate(key(F.col("block"), attempt))])
    by = ["k0", "k1", "block"]
    distinct = single.groupBy(*by).agg(F.lit(0).alias("_")).sortWithinPartitions("block")
    names = write_and_read(distinct.select("k0", "k1", F.monotonically_increasing_id().alias("name")), "naming-blocks")
    return rows, names


def identities(docs: DataFrame, key: BlockKey = hash_key) -> DataFrame:
    """Rows (row, doc_id, text_sha256, level, name): equal (level, name) means equal text."""
    for attempt in range(KEY_TRIES):
        rows, names = _block_names(docs, key, attempt)
        if names.groupBy("k0", "k1").count().filter("count > 1").isEmpty():
            break
    else:
        raise RuntimeError("different blocks share a key in every attempt")
    spread = rows.select("row", F.size("keys").alias("width"), F.posexplode("keys").alias("pos", "key"))
    spread = spread.select("row", "width", "pos", "key.*").join(names, ["k0", "k1"]).drop("k0", "k1")
    level, current, ended = 0, write_and_read(spread, "naming-level"), []
    while True:
        ended.append(current.filter("width = 1").select("row", F.lit(level).alias("level"), "name"))
        open_ = current.filter("width > 1")
        if open_.isEmpty():
            break
        side = F.col("pos") % 2
        pairs = open_.groupBy("row", F.shiftright("pos", 1).alias("pos")).agg(
            F.first(F.shiftright(F.col("width") + 1, 1)).alias("width"),
            F.max(F.when(side == 0, F.col("name"))).alias("left"),
            F.coalesce(F.max(F.when(side == 1, F.col("name"))), F.lit(-1)).alias("right"),  # -1: none, no name is negative
        )
        pairs = write_and_read(pairs, "naming-pairs")
        names = _named(pairs, ["left", "right"], "naming-pair-names")
        current = write_and_read(pairs.join(names, ["left", "right"]).drop("left", "right"), "naming-level")
        level += 1
    found = ended[0]
    for more in ended[1:]:
        found = found.unionByName(more)
    return rows.drop("keys").join(found, "row")


def dedup(docs: DataFrame, key: BlockKey = hash_key) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row per document."""
    named = write_and_read(identities(docs, key), "naming-identities")
    best = F.max(F.struct("doc_id", "row"))
    groups = named.groupBy("level", "name").agg(best.alias("best"), F.count("*").alias("group_size"))
    joined = named.join(groups, ["level", "name"])
    return joined.select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", (F.col("best.row") == F.col("row")).alias("kept"), "text_sha256"
    )


ORACLE = """
SELECT doc_id, max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
  count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
  row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
  sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""


@register("op4_block_naming_dedup", ORACLE)
def op4_block_naming_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(documents(spark, sf_dir))

"""Line deduplication with two Bloom filters.

A line's key is the line without the white space at its ends and with A-Z lower-cased. Keys of at least
``MIN_CHARS`` code points that occur in two documents or more keep their lines only in the document with the
smallest ``doc_id``.

First pass: the hashes of a document's distinct keys go into one filter when they are seen and into another when
they are seen again. Second pass: only keys whose hash is in the second filter are suspected. They alone are
shuffled, and their text decides: keys that really occur in several documents, with the smallest id. Documents
without a suspect pass through unmoved; the others are written once and joined with the lines they lose.

The filters have a fixed upper size. When more lines come in, more are suspected, and the result is the same.

Edge cases: null or empty text is one empty line; repeated rows and other rows with one id are one document, so they
keep the lines of their id; null ids together are one document that comes after all others; a text may lose all its
lines and is then empty; an empty table gives an empty result. Other columns are kept and may have any name but
those that begin with ``__line``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickloom.llm import seen
from clickloom.llm.common import WHITE, ascii_lower, documents, register, write_and_read

MIN_CHARS = 10
HASHES = 2
SLOTS_PER_LINE = 8


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _keys(lines: Column) -> Column:
    """Key of each line, null where it is too short to count."""
    trimmed = F.transform(lines, lambda line: F.btrim(line, F.lit(WHITE)))
    return F.transform(trimmed, lambda line: F.when(F.length(line) >= MIN_CHARS, ascii_lower(line)))


def _hashed(keys: Column) -> Column:
    return F.transform(keys, lambda key: F.when(key.isNotNull(), F.xxhash64(key)))


def _prepared(docs: DataFrame) -> DataFrame:
    """Documents with their lines, keys and hashes."""
    lines = docs.withColumn("__line_all", _lines(F.col("text")))
    keys = lines.withColumn("__line_keys", _keys(F.col("__line_all")))
    return keys.withColumn("__line_hashes", _hashed(F.col("__line_keys")))


def _suspected(hashes: Column, spark: SparkSession, bitmap: bytes, slots: int) -> Column:
    """Positions of the suspected lines."""
    shared = spark.sparkContext.broadcast(bitmap)  # at most MAX_SLOTS bits

    @F.arrow_udf("array<int>")
    def find(rows: pa.Array) -> pa.Array:
        bits = np.frombuffer(shared.value, np.uint8)
        offsets = rows.offsets.to_numpy()
        values = rows.values.slice(offsets[0], offsets[-1] - offsets[0])
        known = values.is_valid().to_numpy(zero_copy_only=False)
        hit = np.zeros(len(values), bool)
        hit[known] = seen.suspects(values.drop_null().to_numpy(zero_copy_only=False), bits, slots, HASHES)
        at = np.flatnonzero(hit)
        starts = offsets - offsets[0]
        bounds = np.searchsorted(at, starts)
        place = at - np.repeat(starts[:-1], np.diff(bounds))
        return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(place.astype(np.int32)))

    return find(hashes)


def dedup_lines(docs: DataFrame) -> DataFrame:
    """Documents with ``text`` cut to the lines that stay, ``__line_n`` lines before and ``__line_dropped`` dropped."""
    spark = docs.sparkSession
    prepared = _prepared(docs)
    breaks = docs.agg(F.sum(F.regexp_count("text", F.lit("\n"))).alias("n"), F.count("*").alias("rows")).first()
    slots = seen.slots_for((breaks["n"] or 0) + breaks["rows"], SLOTS_PER_LINE)
    own = prepared.select(F.array_distinct(F.filter("__line_hashes", lambda h: h.isNotNull())).alias("hashes"))
    bitmap = seen.bitmap(own, slots, HASHES)
    marked = prepared.withColumn("__line_suspects", _suspected(F.col("__line_hashes"), spark, bitmap, slots))

    free = marked.filter(F.size("__line_suspects") == 0)
    free = free.select(*_kept_columns(docs, F.coalesce("text", F.lit("")), F.lit(0)))

    keyed = F.transform(
        "__line_suspects", lambda at: F.struct(at.alias("pos"), F.element_at("__line_keys", at + 1).alias("key"))
    )
    held = marked.filter(F.size("__line_suspects") > 0).withColumn("__line_found", keyed)
    held = held.drop("__line_hashes", "__line_keys", "__line_suspects", "text")
    held = write_and_read(held.withColumn("__line_row", F.monotonically_increasing_id()), "lines-held")
    document = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"))
    found = held.select("__line_row", document.alias("doc"), F.explode("__line_found").alias("f")).select("__line_row", "doc", "f.*")
    found = write_and_read(found, "lines-suspects")
    repeated = found.groupBy("key").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
    repeated = repeated.filter(F.col("first") != F.col("last")).select("key", "first")
    lost = found.join(repeated, "key").filter(F.col("doc") != F.col("first"))
    lost = lost.groupBy("__line_row").agg(F.collect_list("pos").alias("__line_lost"))  # at most the lines of a row
    cut = held.join(lost, "__line_row", "left")
    every = F.sequence(F.lit(0), F.size("__line_all") - 1)
    stay = F.array_except(every, F.coalesce("__line_lost", F.array().cast("array<int>")))
    cut = cut.withColumn("__line_stay", F.transform(stay, lambda at: F.element_at("__line_all", at + 1)))
    dropped = F.size("__line_all") - F.size("__line_stay")
    cut = cut.select(*_kept_columns(docs, F.array_join("__line_stay", "\n"), dropped))
    return free.unionByName(cut)


def _kept_columns(docs: DataFrame, text: Column, dropped: Column) -> list[Column]:
    own = [text.alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns]
    return [*own, F.size("__line_all").cast("long").alias("__line_n"), dropped.cast("long").alias("__line_dropped")]


ORACLE = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (
  SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d),
k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
r AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
j AS (SELECT k.doc_id, k.line, k.pos, r.key IS NULL OR r.first = k.doc_id AS stays FROM k LEFT JOIN r ON k.key = r.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE NOT stays) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE stays), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""


@register("op5_two_filter_line_dedup", ORACLE)
def op5_two_filter_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = dedup_lines(documents(spark, sf_dir))
    return cut.select(
        "doc_id", F.col("__line_n").alias("n_lines"), F.col("__line_dropped").alias("n_dropped"), F.sha2("text", 256).alias("kept_sha256")
    )

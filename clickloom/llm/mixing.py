"""Mixing sources to target weights by Pareto order sampling.

Each source gets a target number of words. A document's expected copies are ``target / source size`` (times
its share of an optional weight), at most ``cap``. Whole copies are certain; the fraction that remains is
the inclusion probability ``p`` of one copy more. Documents are ranked by random odds over inclusion odds,
``(u / (1 - u)) / (p / (1 - p))``, and taken in this order until the words that the certain copies leave
open are filled. The sample size is thus fixed in words: a source misses its target by at most half of the
document at the cut, unless all its documents are used up.

No source is sorted as a whole. A histogram of the ranking key gives the bucket in which the cut falls, and
only the documents of that bucket are ordered. What leaves this step is one cut per source.

Edge cases: null text has size 0; null source is a source of its own, after all others; null ``doc_id`` is
ranked like the empty id; rows equal in id and text share their fate; sources without words get target 0;
an empty table gives an empty result. Only the columns named here are read, so others may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from clickloom.llm.common import documents, register, small, write_and_read

WORD = r"[^\x20\x09-\x0D]+"
SOURCE_WEIGHTS = (3.0, 1.0, 2.0)
SHARE, CAP, SEED = 1.5, 2, "mix-1"
BUCKETS = 4096
BITS = 2.0**52


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(doc_id: Column, seed: str) -> Column:
    """Number in (0, 1) that depends on seed and id alone: 52 bits of an MD5."""
    text = F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(BITS)


def _keyed(docs: DataFrame, weight: Column | None, seed: str) -> DataFrame:
    """Documents with the columns that decide, below one struct column so that no name can clash."""
    text = F.col("text")
    own = F.struct(
        F.col("source").alias("source"),
        n_words(text).alias("size"),
        uniform(F.col("doc_id"), seed).alias("u"),
        (F.lit(1.0) if weight is None else weight.cast("double")).alias("weight"),
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.xxhash64(text).alias("tie"),
    )
    return docs.withColumn("__mix", own)


def source_targets(sizes: DataFrame, weights=SOURCE_WEIGHTS, share=SHARE, cap=CAP) -> DataFrame:
    """Targets from (source, source_size, ...): one row per source.

    The cap is a water level: the sources with the smallest ``cap * size / weight`` are capped, and the
    level is the rest of the words over the rest of the weights. It is where resharing an excess ends.
    """
    numbered = sizes.withColumn("_n", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_n") - 1) % len(weights) + 1)
    most = F.col("source_size") * F.lit(float(cap))
    with_cap = numbered.withColumn("_w", weight).withColumn("_most", most)
    order = W.orderBy(F.col("_most") / F.col("_w"), "_n")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    levels = with_cap.select(
        "*",
        (F.sum("source_size").over(W.partitionBy()) * F.lit(float(share))).alias("_all"),
        F.coalesce(F.sum("_most").over(before), F.lit(0.0)).alias("_capped"),
        F.sum("_w").over(order.rowsBetween(0, W.unboundedFollowing)).alias("_rest"),
    ).withColumn("_level", (F.col("_all") - F.col("_capped")) / F.col("_rest"))
    fits = F.when(F.col("_level") <= F.col("_most") / F.col("_w"), F.struct(F.col("_most") / F.col("_w"), "_n", "_level"))
    level = F.min(fits).over(W.partitionBy())["_level"]
    target = F.least(F.col("_most"), F.coalesce(level * F.col("_w"), F.col("_most")))
    return levels.withColumn("target", target).drop("_n", "_w", "_most", "_all", "_capped", "_rest", "_level")


def _plan(target: Column, weighted_size: Column, cap: int) -> tuple[Column, Column]:
    """Certain copies of a document, and its rank for one copy more (null: no chance of one)."""
    expected = F.least(F.lit(float(cap)), F.coalesce(F.try_divide(target * F.col("__mix.weight"), weighted_size), F.lit(0.0)))
    whole = F.floor(expected)
    p = expected - whole
    u = F.col("__mix.u")
    odds = F.try_divide(u / (F.lit(1.0) - u), p / (F.lit(1.0) - p))
    rank = F.struct(odds.alias("q"), F.col("__mix.id").alias("id"), F.col("__mix.tie").alias("tie"))
    return whole, F.when(p > 0, rank)


def cuts(docs: DataFrame, weights=SOURCE_WEIGHTS, share=SHARE, cap=CAP, weight: Column | None = None, seed=SEED) -> DataFrame:
    """One row per source: size, target and the last ranking key that is taken (null: none)."""
    narrow = write_and_read(_keyed(docs, weight, seed).select("__mix"), "mix-sizes")
    sizes = narrow.groupBy(F.col("__mix.source").alias("source")).agg(
        F.sum("__mix.size").alias("source_size"),
        F.sum(F.col("__mix.size") * F.col("__mix.weight")).alias("weighted_size"),
    )
    targets = write_and_read(source_targets(sizes, weights, share, cap), "mix-targets")
    whole, rank = _plan(F.col("target"), F.col("weighted_size"), cap)
    ranked = narrow.join(small(targets), F.col("__mix.source").eqNullSafe(F.col("source")))
    ranked = ranked.withColumn("__whole", whole).withColumn("__rank", rank)
    # With equal weights the key of a bucket is u itself, so buckets are even; it always grows with the rank.
    mean = F.least(F.coalesce(F.try_divide("target", F.col("source_size")), F.lit(0.0)), F.lit(float(cap)))
    frac = F.greatest(mean - F.floor(mean), F.lit(1e-9))
    scaled = F.col("__rank.q") * (frac / (F.lit(1.0) - frac))
    bucket = F.least(F.floor(scaled / (F.lit(1.0) + scaled) * BUCKETS), F.lit(BUCKETS - 1))
    ranked = ranked.withColumn("__bucket", F.when(F.col("__rank").isNotNull(), F.coalesce(bucket, F.lit(BUCKETS - 1))))
    by_source = W.partitionBy("source")
    counts = ranked.groupBy("source", "__bucket").agg(
        F.sum("__mix.size").alias("_words"),
        F.sum(F.col("__mix.size") * F.col("__whole")).alias("_sure"),
        F.max("__rank").alias("_last"),
        F.first("target").alias("target"),
    )
    left = F.col("target") - F.sum("_sure").over(by_source)
    start = F.coalesce(F.sum("_words").over(by_source.orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    counts = counts.withColumn("_left", left).filter("__bucket is not null").withColumn("_start", start)
    counts = write_and_read(counts, "mix-buckets")
    full = counts.filter(F.col("_start") + F.col("_words") <= F.col("_left")).groupBy("source").agg(F.max("_last").alias("_full"))
    split = counts.filter((F.col("_start") < F.col("_left")) & (F.col("_start") + F.col("_words") > F.col("_left")))
    split = split.select(F.col("source").alias("_source"), F.col("__bucket").alias("_bucket"), "_start", "_left")
    inside = ranked.join(small(split), F.col("source").eqNullSafe(F.col("_source")) & (F.col("__bucket") == F.col("_bucket")))
    earlier = W.partitionBy("source").orderBy("__rank").rowsBetween(W.unboundedPreceding, -1)
    inside = inside.withColumn("_at", F.col("_start") + F.coalesce(F.sum("__mix.size").over(earlier), F.lit(0)))
    part = (
        inside.filter(F.col("_at") * 2 + F.col("__mix.size") <= F.col("_left") * 2)
        .groupBy("source")
        .agg(F.max("__rank").alias("_part"))
    )
    last = full.unionByName(part.withColumnRenamed("_part", "_full")).groupBy(F.col("source").alias("_s")).agg(F.max("_full").alias("last_rank"))
    return write_and_read(
        targets.join(last, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s"), "mix-cuts"
    )


def mix(docs: DataFrame, weights=SOURCE_WEIGHTS, share=SHARE, cap=CAP, weight: Column | None = None, seed=SEED) -> DataFrame:
    """Documents with a struct ``__mix`` of size, source_size, target and copies. No document is moved."""
    cut = cuts(docs, weights, share, cap, weight, seed)
    cut = cut.select(F.struct(F.col("source").alias("s"), *[c for c in cut.columns if c != "source"]).alias("__cut"))
    joined = _keyed(docs, weight, seed).join(small(cut), F.col("__mix.source").eqNullSafe(F.col("__cut.s")))
    names = {f: F.col(f"__cut.{f}") for f in ("source_size", "weighted_size", "target", "last_rank")}
    whole, rank = _plan(names["target"], names["weighted_size"], cap)
    more = F.coalesce(rank <= names["last_rank"], F.lit(False))
    result = F.struct(
        F.col("__mix.size").alias("size"),
        names["source_size"].alias("source_size"),
        names["target"].alias("target"),
        (whole + more.cast("long")).alias("copies"),
    )
    return joined.withColumn("__mix", result).drop("__cut")


def mixed(docs: DataFrame, **how) -> DataFrame:
    """The mixture itself: each document as many times as it has copies, with its own columns."""
    copies = F.explode(F.sequence(F.lit(1), F.col("__mix.copies")))
    return mix(docs, **how).filter("__mix.copies > 0").select(*[F.col(f"`{c}`") for c in docs.columns], copies.alias("__copy")).drop("__copy")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    (CAST('0x' || substr(md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS n FROM d GROUP BY source),
w AS (SELECT *, CASE (n - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS w, source_size * 2.0::DOUBLE AS most FROM s),
l AS (
  SELECT *, ((SELECT sum(source_size) FROM s) * 1.5::DOUBLE
      - coalesce(sum(most) OVER (ORDER BY most / w, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE))
    / sum(w) OVER (ORDER BY most / w, n ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
f AS (SELECT level FROM l WHERE level <= most / w ORDER BY most / w, n LIMIT 1),
t AS (SELECT source, source_size, least(most, coalesce((SELECT level FROM f) * w, most)) AS target FROM l),
e AS (
  SELECT d.*, t.source_size, t.target, CASE WHEN t.source_size = 0 THEN 0.0::DOUBLE ELSE least(t.target / t.source_size, 2.0::DOUBLE) END AS expected
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
q AS (
  SELECT *, floor(expected) AS whole, expected - floor(expected) AS p,
    CASE WHEN expected > floor(expected) THEN (u / (1.0::DOUBLE - u)) / ((expected - floor(expected)) / (1.0::DOUBLE - (expected - floor(expected)))) END AS q FROM e),
c AS (
  SELECT *, target - whole * source_size AS words_left,
    coalesce(sum(size) OVER (PARTITION BY source ORDER BY q, CAST(doc_id AS VARCHAR) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM q)
SELECT doc_id, size, source_size, target,
  CAST(size * (whole + CASE WHEN p > 0 AND before * 2 + size <= words_left * 2 THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM c
"""


@register("op1_pareto_mixture", ORACLE)
def op1_pareto_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.col("__mix")
    return mix(documents(spark, sf_dir)).select(
        "doc_id", m["size"].alias("size"), m["source_size"].alias("source_size"), m["target"].alias("target"),
        (m["size"] * m["copies"]).cast("long").alias("taken"),
    )

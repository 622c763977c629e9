"""Language identification by compression.

Fitting: every language gets a raw-content dictionary of 1 KB slices from at most ``SAMPLE_TEXTS`` labelled texts
(those with the smallest hashes, equal texts once). Every label is learned; with so many that the dictionaries
would hold more than ``ALL_TEXTS`` slices, each language gets fewer, one at least. Every text is classified as a whole.

Classification: the text's letter runs, lower-cased and joined by spaces, are cut into blocks of 4 KB; each block is
compressed by zstandard with each dictionary, and the language with the smallest sum wins. Equal sums go to the
language with more labelled texts. The score is ``1 - smallest / second smallest``. A narrow score (below
``MIN_MARGIN``) rejects the document, as do texts without letters.

Edge cases: null text, or text without a letter: ``und``, score 0, rejected. With a single learned language the
score is 1; with none every document is ``und``. A null ``doc_id`` is not learned from and not held out. Repeated
rows get equal answers. An empty table gives an empty result. Only ``text``, ``lang`` and ``doc_id`` are read.
"""

from __future__ import annotations

from functools import lru_cache

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from clickloom.llm.common import documents, register

SAMPLE_TEXTS = 128
SLICE_CHARS = 1024
ALL_TEXTS = 200 * SAMPLE_TEXTS
BLOCK = 4096
LEVEL = 9
MIN_MARGIN = 0.01
FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"

_LETTERS = regex.compile(r"\p{L}+")

# (language, dictionary bytes), most frequent language first
Model = tuple[tuple[str, bytes], ...]


def held_out() -> Column:
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS
    return F.coalesce(fold == HELD_OUT, F.lit(False))


def normalised(text: str) -> bytes:
    """Lower-case letter runs with single spaces between and around them; empty without letters."""
    words = _LETTERS.findall(text.lower())
    return f" {' '.join(words)} ".encode() if words else b""


def fit(docs: DataFrame) -> Model:
    """Dictionaries from the labelled documents outside the held-out fold."""
    known = docs.select("doc_id", "text", "lang").filter(
        F.col("doc_id").isNotNull() & ~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull()
    )
    known = known.select("lang", "text", F.xxhash64("text").alias("h"))
    hashes = known.groupBy("lang", "h").agg(F.count("*").alias("n"))
    # The smallest hashes of each of 64 parts of a language first, so that no task gets a whole language.
    texts_each = max(1, min(SAMPLE_TEXTS, ALL_TEXTS // max(1, hashes.select("lang").distinct().count())))
    picked = hashes
    for part in (["lang", F.pmod("h", F.lit(64))], ["lang"]):
        first = W.partitionBy(*part).orderBy("h")
        picked = picked.withColumn("at", F.row_number().over(first)).filter(F.col("at") <= texts_each).select("lang", "h")
    sizes = hashes.groupBy("lang").agg(F.sum("n").alias("rows"))
    sample = picked.join(sizes, "lang")  # at most ALL_TEXTS rows, or one a language
    start = F.pmod(F.col("h"), F.greatest(F.length("text") - SLICE_CHARS, F.lit(1))).cast("int") + 1
    slices = known.join(F.broadcast(sample), ["lang", "h"]).groupBy("lang", "rows", "h")
    slices = slices.agg(F.min(F.substring(F.col("text"), start, F.lit(SLICE_CHARS))).alias("slice")).collect()
    texts: dict[tuple, list] = {}
    for r in slices:
        texts.setdefault((-r["rows"], r["lang"]), []).append((r["h"], normalised(r["slice"])))
    model = [(lang, b"".join(t for _, t in sorted(part))) for (_, lang), part in sorted(texts.items())]
    return tuple((lang, content) for lang, content in model if content)


@lru_cache(maxsize=2)
def _compressors(model: Model) -> list[zstandard.ZstdCompressor]:
    made = []
    for _, content in model:
        dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        params = zstandard.ZstdCompressionParameters.from_level(
            LEVEL, dict_size=len(content), source_size=BLOCK, min_match=3, format=zstandard.FORMAT_ZSTD1_MAGICLESS,
            write_content_size=0, write_checksum=0, write_dict_id=0,
        )
        dictionary.precompute_compress(compression_params=params)
        made.append(zstandard.ZstdCompressor(dict_data=dictionary, compression_params=params))
    return made


def classify_text(text: str | None, model: Model) -> tuple[str, float]:
    data = normalised(text) if text else b""
    if not data or not model:
        return UNKNOWN, 0.0
    blocks = [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)]
    sizes = [sum(len(c.compress(b)) for b in blocks) for c in _compressors(model)]
    if len(sizes) == 1:
        return model[0][0], 1.0
    best = min(range(len(sizes)), key=lambda i: (sizes[i], i))
    second = min(s for i, s in enumerate(sizes) if i != best)
    return model[best][0], 1.0 - sizes[best] / second


def language(text: Column, spark: SparkSession, model: Model) -> Column:
    """Struct of lang, score and rejected."""
    shared = spark.sparkContext.broadcast(model)  # ALL_TEXTS KB or so at most, or 1 KB a language
    kind = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])

    @F.arrow_udf("lang string, score double, rejected boolean")
    def classify(texts: pa.Array) -> pa.Array:
        rows = []
        for t in texts:
            lang, score = classify_text(t.as_py(), shared.value)
            rows.append({"lang": lang, "score": score, "rejected": lang == UNKNOWN or score < MIN_MARGIN})
        return pa.array(rows, kind)

    return classify(text)


def predict(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected), one row per document."""
    found = language(F.col("text"), docs.sparkSession, fit(docs) if model is None else model)
    rows = docs.select("doc_id", held_out().alias("held_out"), found.alias("found"))
    return rows.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), "found.score", "found.rejected")


def accepted(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """The documents whose language is not rejected, with their own columns."""
    found = language(F.col("text"), docs.sparkSession, fit(docs) if model is None else model)
    return docs.filter(~found["rejected"])


@register("op10_compression_langid")
def op10_compression_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict(documents(spark, sf_dir))

from __future__ import annotations

import zlib

from pyspark.sql import functions as F

from clickloom.llm import langid
from tests.llm.conftest import AWKWARD, clashing_kept, frame


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    rows = langid.predict(docs).collect()
    assert len(rows) == len(truth)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(truth[r["doc_id"]] == r["lang_pred"] for r in held) / len(held) >= 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert sum(r["rejected"] for r in rows) <= 0.01 * len(rows)


def test_learns_nothing_from_the_held_out_fold(spark, small_sf):
    docs = spark.read.parquet(f"{small_sf}/documents.parquet")
    changed = docs.withColumn("lang", F.when(langid.held_out(), F.lit("xx")).otherwise(F.col("lang")))
    assert langid.fit(docs) == langid.fit(changed)


def test_predictions_use_only_the_text(spark, small_sf):
    docs = spark.read.parquet(f"{small_sf}/documents.parquet")
    model = langid.fit(docs)
    other = docs.select((F.col("doc_id") + 7).alias("doc_id"), "text", F.lit("zz").alias("lang"), F.lit("s").alias("source"), "n_chars")
    one = {r["doc_id"] + 7: r["lang_pred"] for r in langid.predict(docs, model).collect()}
    assert one == {r["doc_id"]: r["lang_pred"] for r in langid.predict(other, model).collect()}


def test_smallest_sum_of_compressed_blocks_wins(spark, small_sf):
    docs = spark.read.parquet(f"{small_sf}/documents.parquet")
    model = langid.fit(docs)
    compressors = langid._compressors(model)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in langid.predict(docs, model).collect():
        data = langid.normalised(texts[r["doc_id"]])
        sizes = [sum(len(c.compress(data[i : i + 4096])) for i in range(0, len(data), 4096)) for c in compressors]
        ranked = sorted(zip(sizes, range(len(sizes)), strict=True))
        assert r["lang_pred"] == model[ranked[0][1]][0]
        assert r["score"] == 1 - ranked[0][0] / ranked[1][0] and r["rejected"] == (r["score"] < langid.MIN_MARGIN)


def test_awkward_rows(spark, awkward, empty):
    rows = langid.predict(awkward).collect()
    assert len(rows) == len(AWKWARD)
    without = {1, 2, 3, 11}
    assert all((r["lang_pred"] == "und") == (r["doc_id"] in without) for r in rows if r["doc_id"] is not None)
    assert all(r["score"] == 0 and r["rejected"] for r in rows if r["lang_pred"] == "und")
    assert not any(r["held_out"] for r in rows if r["doc_id"] is None)
    kept = langid.accepted(awkward)
    assert kept.columns == awkward.columns and clashing_kept(kept)
    assert not {r["doc_id"] for r in kept.collect()} & without
    assert langid.predict(empty).count() == 0


def test_one_language_and_none(spark):
    rows = [(i, f"some words of text number {i}", lang, "s", 0) for i, lang in ((0, "en"), (1, "en"), (3, "en"))]
    assert {(r["lang_pred"], r["score"]) for r in langid.predict(frame(spark, rows)).collect()} == {("en", 1.0)}
    nameless = [(*r[:2], None, *r[3:]) for r in rows]
    assert {(r["lang_pred"], r["score"]) for r in langid.predict(frame(spark, nameless)).collect()} == {("und", 0.0)}


def test_every_label_is_learned(spark, monkeypatch):
    """More labels than 200, and fewer slices a language when there are many."""
    rows = [(8 * i + j, f"word{i} {'abcdefgh'[j]} text{i}", f"l{i:03}", "s", 0) for i in range(230) for j in range(8)]
    docs = frame(spark, rows, False)
    assert {lang for lang, _ in langid.fit(docs)} == {r[2] for r in rows}
    monkeypatch.setattr(langid, "ALL_TEXTS", 2 * 230)
    model = langid.fit(docs)
    assert len(model) == 230 and all(content.count(b"word") <= 2 for _, content in model)

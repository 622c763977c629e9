"""The pipeline against plain code, stage by stage, each on its own input."""

from __future__ import annotations

import hashlib

import pytest

import corpus_pipeline
from clickloom.llm import bpe, langid, mixing
from clickloom.session import write_and_read
from tests.llm.test_jaccard import plain as plain_components
from tests.llm.test_line_dedup import plain as plain_lines
from tests.llm.conftest import frame

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, small_sf):
    docs = spark.read.parquet(f"{small_sf}/documents.parquet")
    tables = [docs]
    for name, stage in corpus_pipeline.STAGES:
        tables.append(write_and_read(stage(spark, tables[-1], small_sf), f"test-{name}"))
    return [[tuple(r) for r in t.collect()] for t in tables], [t.columns for t in tables]


def test_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "ngram_jaccard", "source_mixture", "byte_bpe"]
    assert stages[1][:5] == [COLUMNS] * 5
    assert corpus_pipeline.ORACLE_SQL is None


def test_language_id(spark, stages):
    start, after = stages[0][0], stages[0][1]
    model = langid.fit(frame(spark, start, False))
    found = {r[0]: langid.classify_text(r[1], model) for r in start}
    assert sorted(after) == sorted(r for r in start if found[r[0]][0] != "und" and found[r[0]][1] >= langid.MIN_MARGIN)
    assert len(after) >= 0.97 * len(start)


def test_line_dedup(stages):
    start, after = stages[0][1], stages[0][2]
    want = {d: text for d, text, *_ in plain_lines(start)}
    assert {r[0]: r[1] for r in after} == want and len(after) == len(start)
    assert all(r[4] == len(r[1]) for r in after)


def test_near_duplicates(stages):
    start, after = stages[0][2], stages[0][3]
    assert sorted(after) == sorted(r for r, found in zip(sorted(start), sorted(plain_components(start), key=lambda x: x[0]), strict=True) if found[0] == found[2])


def test_near_duplicates_link_at_five_words_and_80_percent(spark):
    """Pairs on both sides of 0.8: 300 words, the second text with a run of them replaced."""
    rows = []
    for n in range(15, 34):
        words = [f"w{n}x{i}" for i in range(300)]
        rows.append((2 * n, " ".join(words), "en", "s", 0))
        words[100 : 100 + n] = [f"other{n}x{i}" for i in range(n)]
        rows.append((2 * n + 1, " ".join(words), "en", "s", 0))
    kept = dict(corpus_pipeline.STAGES)["ngram_jaccard"](spark, frame(spark, rows, False), "")
    want = sorted(d for d, _, first in plain_components(rows, 5, 80) if d == first)
    assert sorted(r["doc_id"] for r in kept.collect()) == want
    assert want != sorted(d for d, _, first in plain_components(rows) if d == first)


def test_mixture(spark, stages):
    start, after = stages[0][3], stages[0][4]
    rows = mixing.mix(frame(spark, start, False)).select("doc_id", "__mix.copies").collect()
    copies = {r["doc_id"]: r["copies"] for r in rows}
    assert sorted(after) == sorted(r for r in start for _ in range(copies[r[0]]))


def test_byte_bpe(stages):
    start, after = stages[0][4], stages[0][5]
    path, pattern = bpe.default_tokenizer()
    want = []
    for doc_id, text, _, source, _ in start:
        ids = bpe._encoding(path, pattern).encode_ordinary(text)
        want.append((doc_id, source, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert sorted(after) == sorted(want)


def test_run_equals_its_stages(spark, small_sf, stages):
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, small_sf).collect()) == sorted(stages[0][5])


def test_awkward_and_empty(spark, awkward, empty):
    for docs, any_left in ((awkward, True), (empty, False)):
        docs = docs.select(COLUMNS)
        for name, stage in corpus_pipeline.STAGES:
            docs = write_and_read(stage(spark, docs, ""), f"test-{name}")
        assert (docs.count() > 0) == any_left

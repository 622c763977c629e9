from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from clickloom.llm import block_naming
from tests.llm.conftest import AWKWARD, frame


def check(docs, rows, key=block_naming.hash_key):
    got = block_naming.dedup(docs, key).collect()
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[text or ""].append(doc_id)
    digest = {hashlib.sha256(t.encode()).hexdigest(): t for t in groups}
    assert len(got) == len(rows)
    for text, ids in groups.items():
        own = [r for r in got if digest[r["text_sha256"]] == text]
        keep = max((i for i in ids if i is not None), default=None)
        assert sorted((r["doc_id"] for r in own), key=str) == sorted(ids, key=str)
        assert {r["keep_id"] for r in own} == {keep} and {r["group_size"] for r in own} == {len(ids)}
        assert [r["doc_id"] for r in own if r["kept"]] == [keep]


def test_awkward_rows(spark, awkward, empty):
    check(awkward, AWKWARD)
    assert block_naming.dedup(empty).count() == 0


@pytest.mark.parametrize("block", [1, 3, 8])
def test_texts_of_many_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(block_naming, "BLOCK_BYTES", block)
    random.seed(block)
    texts = ["".join(random.choice("aé") for _ in range(random.randint(0, 9))) for _ in range(60)] + ["aaaa" * 9, "aaaa" * 9 + "a", "aaa" * 12]
    rows = [(i, random.choice(texts), "en", "s", 0) for i in range(300)]
    check(frame(spark, rows), rows)


def test_keys_that_collide_are_noticed_and_replaced(spark):
    tried = []

    def weak(block, attempt):
        tried.append(attempt)
        if attempt == 0:
            return [F.length(block).cast("long"), F.lit(0).cast("long")]
        return block_naming.hash_key(block, attempt)

    rows = [(i, f"text {i % 7}", "en", "s", 0) for i in range(50)]
    check(frame(spark, rows), rows, weak)
    assert max(tried) == 1
    with pytest.raises(RuntimeError):
        block_naming.dedup(frame(spark, rows), lambda block, attempt: [F.length(block).cast("long"), F.lit(0).cast("long")])

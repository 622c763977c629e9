from __future__ import annotations

import random
import zlib

import pytest

from clickloom.llm import sharding
from tests.llm.conftest import frame


def plain_tree(rows, shards):
    """The same tree over lists: rows are (coordinates, h1, h2, size)."""
    spread = [max(r[0][d] for r in rows) - min(r[0][d] for r in rows) for d in range(sharding.DIMS)]

    def bits(h, at):
        return (h % 2**64 >> (54 - 10 * at)) & 1023

    def split(rows, k):
        if k < 2 or not rows:
            return [rows] * (k == 1) if k < 2 else [[]] * k
        low = [min(r[0][d] for r in rows) for d in range(sharding.DIMS)]
        width = [max(r[0][d] for r in rows) - low[d] for d in range(sharding.DIMS)]
        d = max(range(sharding.DIMS), key=lambda d: width[d] / spread[d] if spread[d] else 0.0)

        def key(r):
            at = min(sharding.BINS - 1, int((r[0][d] - low[d]) / width[d] * sharding.BINS)) if width[d] else 0
            return (at, *(bits(r[1], i) for i in range(3)))

        total = sum(r[3] for r in rows)
        cells = {}
        for r in rows:
            cells.setdefault(key(r), []).append(r)
        goal, before, left, right = total * (k // 2) / k, 0, [], []
        for at in sorted(cells):
            size = sum(r[3] for r in cells[at])
            if right or before >= goal:
                right += cells[at]
            elif before + size < goal:
                left += cells[at]
            else:
                parts = [cells[at]]
                if size > sharding.WHOLE_GROUP * total / k:
                    parts = [[r for r in cells[at] if bits(r[2], 0) == i] for i in range(1024)]
                inner, closed = before, False
                for part in parts:
                    weight = sum(r[3] for r in part)
                    if closed:
                        right += part
                    elif inner + weight < goal:
                        left += part
                    elif part:
                        (left if abs(inner + weight - goal) < abs(goal - inner) else right).extend(part)
                        closed = True
                    inner += weight
                before = max(goal, before + size)
                continue
            before += size
        return split(left, k // 2) + split(right, k - k // 2)

    return split(rows, shards)


@pytest.mark.parametrize("shards", [1, 3, 16])
def test_equals_the_tree_over_lists(spark, shards):
    random.seed(5)
    rows = [(i, "a" * int(random.lognormvariate(4, 1)), random.choice(["en", "de", None]), f"src{random.randint(0, 9)}", 0) for i in range(1500)]
    docs = frame(spark, rows)
    meta = sharding.metadata(docs).collect()
    want = plain_tree([(tuple(r["at"]), r["h1"], r["h2"], r["size"], r["doc_id"]) for r in meta], shards)
    got = {r["doc_id"]: r["shard"] for r in sharding.shard(docs, shards=shards).collect()}
    parts = [sorted(r[4] for r in part) for part in want]
    mine = [sorted(d for d, s in got.items() if s == i) for i in range(shards)]
    assert sorted(mine) == sorted(parts)


def test_bytes_are_near_equal_and_slots_are_dense(spark, monkeypatch):
    monkeypatch.setattr(sharding, "SLOT_ROWS", 20)
    random.seed(6)
    docs = frame(spark, [(i, "é" * random.randint(0, 400), "en", "s", 0) for i in range(4000)])
    rows = sharding.shard(docs, shards=16).collect()
    mean = sum(r["size"] for r in rows) / 16
    for s in range(16):
        own = [r for r in rows if r["shard"] == s]
        assert abs(sum(r["size"] for r in own) - mean) < 0.03 * mean
        assert sorted(r["slot"] for r in own) == list(range(len(own)))


def test_copies_stay_together(spark):
    random.seed(8)
    texts = [f"text {i} " * random.randint(1, 30) for i in range(2000)]
    docs = frame(spark, [(i, random.choice(texts), random.choice(["en", "de"]), f"s{i % 9}", 0) for i in range(6000)])
    rows = sharding.shard(docs, shards=16).collect()
    by_text, mean = {}, sum(r["size"] for r in rows) / 16
    for r in rows:
        by_text.setdefault(r["text_crc32"], set()).add(r["shard"])
    assert all(len(shards) == 1 for shards in by_text.values())
    sums = [sum(r["size"] for r in rows if r["shard"] == s) for s in range(16)]
    assert max(sums) < 1.06 * mean and min(sums) > 0.94 * mean


def test_a_group_of_copies_larger_than_a_shard_is_split(spark):
    docs = frame(spark, [(i, "copy " * 20 if i % 3 else f"text {i} " * 12, "en", "s", 0) for i in range(3000)])
    rows = sharding.shard(docs, shards=8).collect()
    mean = sum(r["size"] for r in rows) / 8
    sums = [sum(r["size"] for r in rows if r["shard"] == s) for s in range(8)]
    assert max(sums) < 1.1 * mean and min(sums) > 0.9 * mean


def test_target_bytes(spark):
    docs = frame(spark, [(i, "x" * 99, "en", "s", 0) for i in range(100)])
    assert {r["shard"] for r in sharding.shard(docs, target_bytes=2500).collect()} == {0, 1, 2, 3}
    with pytest.raises(ValueError):
        sharding.shard(docs, target_bytes=1)


def test_awkward_rows(awkward, empty):
    rows = sharding.shard(awkward, shards=4).collect()
    assert len(rows) == awkward.count()
    by_id = {r["doc_id"]: r for r in rows}
    assert (by_id[1]["size"], by_id[1]["text_crc32"]) == (1, 0) and (by_id[2]["size"], by_id[2]["text_crc32"]) == (1, 0)
    text = "  SAME TEXT here, copied often.  \nÉtude à part Ünïcode".encode()
    assert (by_id[6]["size"], by_id[6]["text_crc32"]) == (len(text) + 1, zlib.crc32(text))
    for s in {r["shard"] for r in rows}:
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sum(r["shard"] == s for r in rows)))
    assert sharding.shard(empty, shards=16).count() == 0

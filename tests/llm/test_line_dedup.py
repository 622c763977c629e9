from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest

from clickloom.llm import line_dedup, seen
from tests.llm.conftest import AWKWARD, clashing_kept, frame

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows):
    def key(line):
        found = line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
        return found if len(found) >= 10 else None

    holders = defaultdict(set)
    for doc_id, text, *_ in rows:
        for line in (text or "").split("\n"):
            holders[key(line)].add((doc_id is None, doc_id or 0))
    out = []
    for doc_id, text, *_ in rows:
        lines = (text or "").split("\n")
        stay = [x for x in lines if key(x) is None or min(holders[key(x)]) == (doc_id is None, doc_id or 0)]
        out.append((doc_id, "\n".join(stay), len(lines), len(lines) - len(stay)))
    return sorted(out, key=str)


def got(docs):
    return sorted((tuple(r) for r in line_dedup.dedup_lines(docs).select("doc_id", "text", "__line_n", "__line_dropped").collect()), key=str)


def test_awkward_rows(awkward, empty):
    assert got(awkward) == plain(AWKWARD)
    cut = line_dedup.dedup_lines(awkward)
    assert cut.columns[: len(awkward.columns)] == awkward.columns and clashing_kept(cut)
    assert got(empty) == []


def random_rows(seed, n=300):
    random.seed(seed)
    lines = ["", " ", "short", "  Exactly 10", "exactly 10\t", "ÉCOLE élémentaire", "école élémentaire", "\x0b a line that repeats \x0c"]
    lines += [f"Line number {i} of some length" for i in range(60)]
    texts = ["\n".join(random.choice(lines) for _ in range(random.randint(1, 12))) for _ in range(n)]
    ids = [random.choice([*range(200), None]) for _ in range(n)]
    return [(i, t, "en", "s", 0) for i, t in zip(ids, texts, strict=True)]


@pytest.mark.parametrize("seed", range(3))
def test_random_lines(spark, seed):
    rows = random_rows(seed)
    assert got(frame(spark, rows)) == plain(rows)


def test_full_filters_only_make_more_suspects(spark, monkeypatch):
    monkeypatch.setattr(seen, "MIN_SLOTS", 2**16)
    monkeypatch.setattr(seen, "MAX_SLOTS", 2**16)
    monkeypatch.setattr(seen, "FLUSH", 100)
    rows = [(i, "\n".join(f"line {random.randint(0, 10**6)} of a corpus" for _ in range(40)), "en", "s", 0) for i in range(2000)]
    assert got(frame(spark, rows)) == plain(rows)


def test_a_line_of_a_third_of_all_documents(spark):
    rows = [(i, f"own line of document {i}\nEverybody has this line" if i % 3 == 0 else f"own line {i}", "en", "s", 0) for i in range(900)]
    assert got(frame(spark, rows)) == plain(rows)


@pytest.mark.parametrize("k", [1, 2])
def test_bitmap_has_every_repeated_hash(spark, monkeypatch, k):
    monkeypatch.setattr(seen, "FLUSH", 50)
    random.seed(k)
    rows = [([random.randint(-(2**63), 2**63 - 1) if random.random() < 0.7 else random.randint(0, 40) for _ in range(5)],) for _ in range(200)]
    rows = [(list(dict.fromkeys(r[0])),) for r in rows]
    slots = 2**20
    times = defaultdict(int)
    for (hashes,) in rows:
        for h in hashes:
            times[h] += 1
    df = spark.createDataFrame(rows, "hashes array<long>").repartition(4)
    every = np.array(list(times), np.int64)
    for least in (1, 2):
        bits = np.frombuffer(seen.bitmap(df, slots, k, times=least), np.uint8)
        found = dict(zip(times, seen.suspects(every, bits, slots, k), strict=True))
        assert all(found[h] for h, n in times.items() if n >= least)
        assert sum(found[h] for h, n in times.items() if n < least) < 10


def test_slots_grow_with_the_input_up_to_a_bound():
    assert seen.slots_for(1, 8) == seen.MIN_SLOTS
    assert seen.slots_for(10**7, 8) == 2**27
    assert seen.slots_for(10**15, 8) == seen.MAX_SLOTS

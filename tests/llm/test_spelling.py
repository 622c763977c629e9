from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from clickloom.llm import spelling
from tests.llm.conftest import AWKWARD, frame

WORDS = "word string, n long"


def counted(rows, min_chars=6, min_count=5, every=199):
    """Vocabulary word by word, as the contract says it."""
    n = Counter()
    for doc, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= min_chars:
                n[run] += 1
    return {w: c for w, c in n.items() if c >= min_count}


def near(a, b):
    """Whether exactly one code point is inserted, deleted or replaced."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def plain(words, ratio=5):
    """All pairs, all chains."""
    rows, form = {}, {}
    for w, n in words.items():
        others = [o for o in words if near(w, o)]
        top = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = top if top is not None and words[top] >= ratio * n else None
        rows[w] = (n, len(others))
    out = []
    for w, (n, k) in rows.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, k, words.get(form[w])))
    return sorted(out)


def result(df):
    return sorted(tuple(r) for r in df.collect())


def some_words(seed, n=250):
    rng = random.Random(seed)
    words = {}
    for _ in range(n):
        w = "".join(rng.choice("abéÿ") for _ in range(rng.randint(6, 9)))
        words[w] = rng.choice([5, 6, 30, 200, 1500])
    for stem in ("prefixed", "shared", "ÿÿÿÿÿÿ"):  # hot halves at either end
        for a in "abcd":
            for b in "abce":
                words[stem + a + b] = rng.choice([5, 27, 140])
                words[a + b + stem + stem] = rng.choice([5, 27, 140])
    return words


@pytest.mark.parametrize("seed, pairs_a_row", [(0, 32), (1, 0)])
def test_equals_all_pairs(spark, monkeypatch, seed, pairs_a_row):
    words = some_words(seed, 250 if pairs_a_row else 60)
    monkeypatch.setattr(spelling.near_pairs, "__defaults__", (pairs_a_row,))
    df = spark.createDataFrame(list(words.items()), WORDS).repartition(3)
    assert result(spelling.grouped(df)) == plain(words)


def test_a_hot_half_is_halved_again(spark):
    """Words that share a half are not all paired: what is verified follows rows and results."""
    rng = random.Random(4)
    words = {"commonbeginning" + "".join(rng.choice("abcdefgh") for _ in range(15)): 5 for _ in range(600)}
    some = next(iter(words))
    words[some[:-1]] = 30
    words[some[:20] + "z" + some[20:]] = 200
    rows = spelling._halved(spelling._starts(spark.createDataFrame(list(words.items()), WORDS)))
    assert rows.groupBy("key").count().agg({"count": "max"}).first()[0] > 600
    seen = []
    met = spelling._met

    def counting(keys):
        chunks, grams = keys.filter("chunk").select("key"), keys.filter("NOT chunk").select("key")
        seen.append(chunks.join(grams, "key").count())
        return met(keys)

    spelling._met = counting
    try:
        df = spark.createDataFrame(list(words.items()), WORDS)
        assert result(spelling.grouped(df)) == plain(words)
    finally:
        spelling._met = met
    assert len(seen) > 1 and sum(seen) < 40 * len(words)


def test_chains_end_at_their_root(spark):
    words = {"abcdef" + "g" * i: 5 * 5**i for i in range(9)}
    rows = {r["word"]: r["root"] for r in spelling.grouped(spark.createDataFrame(list(words.items()), WORDS)).collect()}
    assert set(rows.values()) == {"abcdef" + "g" * 8}


@pytest.mark.parametrize("every", [199, 3])
def test_vocabulary(spark, every):
    rng = random.Random(7)
    texts = [" ".join(rng.choice(["Straße", "ÉTUDES", "etudes", "x×÷yzzz", "naïveté", "don't-stopping", "漢字word12word", "abcdefg"]) for _ in range(50)) for _ in range(40)]
    rows = [(i if i % 5 else None, t) for i, t in enumerate(texts)] + [(1, None), (2, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert dict(result(spelling.vocabulary(docs, every=every))) == counted(rows, every=every)


def test_awkward_rows(awkward, empty, spark):
    rows = [(r[0], r[1]) for r in AWKWARD]
    assert result(spelling.grouped(spelling.vocabulary(awkward))) == plain(counted(rows))
    assert spelling.grouped(spelling.vocabulary(empty)).count() == 0
    long = [(i, "x" * 50_000 + " " + "x" * 49_999 + "y Long" + "z" * 6) for i in range(6)]
    got = result(spelling.grouped(spelling.vocabulary(frame(spark, [(*r, "en", "a", 1) for r in long]))))
    assert got == plain(counted(long))


def test_words_in_two_tasks_are_one(spark):
    docs = spark.createDataFrame([(i, "Repeated") for i in range(9)], "doc_id long, text string").repartition(3)
    assert result(spelling.vocabulary(docs)) == [("repeated", 9)]

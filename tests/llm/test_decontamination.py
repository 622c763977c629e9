from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from clickloom.llm import decontamination as dc
from tests.llm.conftest import AWKWARD, clashing_kept, frame

ITEMS = "item_id long, text string"


def plain(texts: list[str | None], items: list[tuple[object, str | None]], window: int = dc.WINDOW) -> list[tuple]:
    """The digests by search of every window in every text."""
    out = []
    keys = {}
    for item, text in items:
        found = dc._WORD.findall(dc.lowered(text or ""))
        for at in range(max(1, len(found) - window + 1)):
            if found:
                keys.setdefault(tuple(found[at : at + window]), set()).add(item)
    for text in texts:
        found = dc._WORD.findall(dc.lowered(text or ""))
        hit, seen = set(), set()
        for n in {len(k) for k in keys}:
            for at in range(len(found) - n + 1):
                if (key := tuple(found[at : at + n])) in keys:
                    hit.update(range(at, at + n))
                    seen |= keys[key]
        names = sorted(str(s) for s in seen if s is not None)
        out.append((len(found), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return out


def digests(found):
    return sorted((tuple(r) for r in dc.digests(found).collect()), key=str)


def texts_and_items(seed, n=60):
    """Texts of few different words, so that windows overlap, with whole and cut passages of the items."""
    rng = random.Random(seed)
    some = lambda k: " ".join(rng.choice(["a", "B", "c1", "é", "Dd"]) for _ in range(k))
    items = [(i % 9 if i % 7 else None, some(rng.choice([0, 1, 3, 9, 10, 11, 25]))) for i in range(20)]
    items += [(30, "Shared Passage, of ten words - that 3 items all have! " + some(5)) for _ in range(3)] + [(31, None), (32, "!?")]
    texts = []
    for i in range(n):
        text = some(rng.randrange(60))
        if i % 3 == 0:
            text += "\n " + items[rng.randrange(20)][1].upper().replace(" ", " -\t") + " " + some(4)
        texts.append(text)
    return texts, items


@pytest.mark.parametrize("seed, part_bytes, slice_words", [(0, 1 << 20, 1000), (1, 250, 12)])
def test_equals_plain_search(spark, seed, part_bytes, slice_words):
    texts, items = texts_and_items(seed)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    benchmark = spark.createDataFrame(items, ITEMS)
    if part_bytes < 1000:
        items = items[:9] + items[-5:]
        benchmark = spark.createDataFrame(items, ITEMS)
        assert 1 < len(list(dc.parts(benchmark, part_bytes=part_bytes, slice_words=slice_words))) < 20
    found = dc.find(docs, benchmark, part_bytes=part_bytes, slice_words=slice_words)
    assert digests(found) == sorted(((i, *d) for i, d in enumerate(plain(texts, items))), key=str)


def test_slices_hold_every_window():
    for n in range(0, 60):
        found = [b"%d" % i for i in range(n)]
        cut = dc._cut(found, 10, 14)
        windows = {tuple(s[a : a + 10]) for s in cut for a in range(max(1, len(s) - 9))}
        assert windows == {tuple(found[a : a + 10]) for a in range(max(1, n - 9))}
        assert all(len(s) <= 14 for s in cut)


def test_offsets_are_those_of_the_original(spark):
    item = "Wörter Eins zwei DREI vier fünf sechs sieben acht neun zehn"
    text = f"Ünd davor; 𝔘 !! {item.upper()[:0]}{item.replace(' ', ' -- ')}\n... danach {item}"
    docs = spark.createDataFrame([(1, text), (2, "clean")], "doc_id long, text string")
    benchmark = spark.createDataFrame([(7, item)], ITEMS)
    rows = {r["doc_id"]: r for r in dc.spans(dc.find(docs, benchmark)).collect()}
    assert [text[s["start"] : s["end"]] for s in rows[1]["spans"]] == [item.replace(" ", " -- "), item]
    assert rows[1]["found"]["items"] == ["7"] and rows[2]["spans"] == []


def test_awkward_rows(awkward, empty, spark):
    items = [(1, "Same text here, copied often. Second line of it"), (2, " ".join(f"word{i} other{i}" for i in range(5, 11))), (3, "one two"), (4, None), (None, "x" * 300_000)]
    benchmark = spark.createDataFrame(items, ITEMS).withColumn("text_len", F.length("text"))
    got = digests(dc.find(awkward, benchmark))
    want = [(r[0], *p) for r, p in zip(AWKWARD, plain([r[1] for r in AWKWARD], items), strict=True)]
    assert got == sorted(want, key=str)
    kept = dc.decontaminated(awkward, benchmark)
    assert kept.columns == awkward.columns and clashing_kept(kept)
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == sorted((w[0] or 0) for w in want if not w[-1])
    assert dc.digests(dc.find(empty, benchmark)).count() == 0
    none = dc.digests(dc.find(awkward, spark.createDataFrame([], ITEMS)))
    assert none.count() == len(AWKWARD) and none.filter("contaminated OR n_hit > 0 OR n_items > 0").isEmpty()


def test_a_passage_in_a_third_of_documents_and_items(spark):
    passage = " ".join(f"w{i}" for i in range(12))
    docs = frame(spark, [(i, f"intro {i} {passage if i % 3 == 0 else ''}", "en", "a", 1) for i in range(300)], clashing=False)
    benchmark = spark.createDataFrame([(i, passage + f" end{i}") for i in range(90)], ITEMS)
    rows = dc.digests(dc.find(docs, benchmark)).collect()
    assert sum(r["contaminated"] for r in rows) == 100
    assert {(r["n_hit"], r["n_items"]) for r in rows if r["contaminated"]} == {(12, 90)}

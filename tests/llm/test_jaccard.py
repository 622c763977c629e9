from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest

from clickloom.llm import jaccard
from clickloom.llm.components import components
from tests.llm.conftest import AWKWARD, clashing_kept, frame


def plain_sets(texts, width):
    sets = []
    for text in texts:
        words = (text or "").encode().lower().split()
        if len(words) >= width:
            sets.append(frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1)))
        else:
            sets.append(frozenset([tuple(words)]) if words else frozenset())
    return sets


def plain(rows, width=4, percent=85):
    """(doc_id, n, component_id) by comparing all pairs that share a shingle."""
    sets = plain_sets([r[1] for r in rows], width)
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = defaultdict(list)
    for i, s in enumerate(sets):
        shared = Counter(j for x in s for j in where[x])
        for j, n in shared.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                parent[find(i)] = find(j)
        for x in s:
            where[x].append(i)
    ids = defaultdict(list)
    for i, r in enumerate(rows):
        ids[find(i)].append(r[0])
    least = {k: min((d for d in v if d is not None), default=None) for k, v in ids.items()}
    return sorted(((r[0], len(s), least[find(i)]) for i, (r, s) in enumerate(zip(rows, sets, strict=True))), key=str)


def got(docs, **how):
    return sorted((tuple(r) for r in jaccard.jaccard_components(docs, **how).select("doc_id", "n_shingles", "component_id").collect()), key=str)


def test_awkward_rows(awkward, empty):
    assert got(awkward) == plain(AWKWARD)
    assert got(empty) == []


def near_copies(seed, n, length, most, words=40):
    """Texts in families: a stem with some words replaced, dropped or added."""
    random.seed(seed)
    out = []
    for i in range(n):
        if not out or random.random() < 0.15:
            text = [f"w{random.randint(0, words)}" for _ in range(random.randint(1, length))]
        else:
            text = list(random.choice(out))
            for _ in range(random.randint(0, most)):
                at = random.randint(0, len(text) - 1)
                change = random.random()
                if change < 0.5:
                    text[at] = f"n{random.randint(0, 9999)}"
                elif change < 0.75 and len(text) > 1:
                    del text[at]
                else:
                    text.insert(at, f"n{random.randint(0, 9999)}")
        out.append(text)
    return [(i, " ".join(t), "en", "s", 0) for i, t in enumerate(out)]


@pytest.mark.parametrize(
    ("seed", "length", "most", "width", "percent", "words"),
    [(1, 60, 2, 4, 85, 4000), (2, 200, 6, 4, 85, 4000), (3, 12, 1, 2, 60, 30), (4, 80, 8, 4, 70, 4000), (5, 20, 2, 1, 50, 60), (6, 100, 3, 4, 85, 3)],
)
def test_families_of_near_copies(spark, seed, length, most, width, percent, words):
    rows = near_copies(seed, 350, length, most, words)
    assert got(frame(spark, rows, False), width=width, percent=percent) == plain(rows, width, percent)


def test_few_slots_only_make_more_suspects(spark, monkeypatch):
    monkeypatch.setattr(jaccard.seen, "MIN_SLOTS", 2**16)
    monkeypatch.setattr(jaccard.seen, "MAX_SLOTS", 2**16)
    monkeypatch.setattr(jaccard.seen, "FLUSH", 500)
    rows = near_copies(7, 300, 900, 20, 50_000)
    assert got(frame(spark, rows, False)) == plain(rows)


def test_members_link_where_leaders_do_not(spark):
    """A chain in which neighbours link and the ends do not: links between members of two stars decide."""
    stem = [f"s{i}" for i in range(103)]
    rows = []
    for i in range(12):
        text = list(stem)
        for j in range(i):
            text[4 + 8 * j] = f"x{j}"
        rows.append((i, " ".join(text), "en", "s", 0))
    want = plain(rows)
    assert got(frame(spark, rows, False)) == want and len({r[2] for r in want}) < len({r[0] for r in want})


def test_group_of_many_near_copies_makes_few_pairs(spark, monkeypatch):
    random.seed(9)
    stem = [f"s{i}" for i in range(200)]
    rows = []
    for i in range(600):
        text = list(stem)
        for _ in range(3):
            text[random.randint(0, 199)] = f"x{random.randint(0, 10**6)}"
        rows.append((i, " ".join(text), "en", "s", 0))
    pairs = []
    compared = jaccard.Join.compared

    def counted(self, some, sets):
        pairs.append(some.count())
        return compared(self, some, sets)

    monkeypatch.setattr(jaccard.Join, "compared", counted)
    assert got(frame(spark, rows, False)) == plain(rows)
    assert sum(pairs) < 5 * len(rows)


def test_representatives(spark, awkward, empty):
    kept = jaccard.representatives(awkward)
    assert kept.columns == awkward.columns and clashing_kept(kept)
    ids = sorted((r["doc_id"] for r in kept.collect()), key=str)
    assert ids == sorted([1, 2, 3, 4, 6, 7, 9, 10, 11, 12, None], key=str)  # the null id is the row without a text
    assert jaccard.representatives(empty).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    random.seed(seed)
    edges = [(random.randint(0, 150), random.randint(0, 150)) for _ in range(110)] + [(i, i + 1) for i in range(200, 260)]
    parent = list(range(300))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {n: find(n) for n in nodes}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0

from __future__ import annotations

import random
import re

import pytest

from clickloom.llm import licenses
from tests.llm.conftest import AWKWARD, frame

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(text):
    words = WORD.findall((text or "").translate(LOWER))
    hits = [
        (i, label)
        for phrase, label in licenses.PHRASES.items()
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    starts = [i for i, _ in hits]
    return (len(words), len(hits), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in hits})))


def shortened(found):
    return tuple(found[k] for k in ("n_words", "n_base", "first_word", "last_word", "base_labels"))


def test_awkward_rows(awkward, empty):
    rows = licenses.scan(awkward).collect()
    key = lambda r: str(tuple(r))
    assert sorted([(r["doc_id"], *shortened(r)) for r in rows], key=key) == sorted([(d, *plain(t)) for d, t, *_ in AWKWARD], key=key)
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert licenses.scan(empty).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_base_places_in_random_words(seed):
    random.seed(seed)
    words = ["gnu", "GENERAL", "public", "license", "apache", "cc", "by", "mit", "the", "Ünï", "x", "4", "by-", "cc.by"]
    for _ in range(400):
        text = random.choice([" ", "-", "\n"]).join(random.choice(words) for _ in range(random.randint(0, 60)))
        assert shortened(licenses.scan_text(text)) == plain(text)


@pytest.mark.parametrize("seed", range(4))
def test_matching_statistics_are_the_longest_runs(seed):
    random.seed(seed)
    letters = "abc"
    templates = [" ".join(random.choice(letters) for _ in range(random.randint(1, 14))) for _ in range(4)]
    automaton = licenses.Automaton([("x", t, False) for t in templates])
    lists = [t.split() for t in templates]
    text = [random.choice(letters) for _ in range(200)]
    ids = [automaton.vocabulary.get(w.encode(), 0) for w in text]

    def inside(part):
        return any(x[j : j + len(part)] == part for x in lists for j in range(len(x)))

    for i, state, length in licenses.statistics(ids, automaton):
        longest = max(n for n in range(i + 2) if n == 0 or inside(text[i + 1 - n : i + 1]))
        assert length == longest
        if length:
            part = text[i + 1 - length : i + 1]
            ends = {(t, j + length) for t, x in enumerate(lists) for j in range(len(x)) if x[j : j + length] == part}
            assert set(automaton.ends[state]) == ends


@pytest.mark.parametrize(("label", "notice"), licenses.NOTICES)
def test_notices_are_found_whole_and_with_changes(label, notice):
    found = licenses.scan_text(f"Some code and the words of it. {notice} More of it")
    assert label in found["labels"].split(",") and found["score"] == 1.0
    span = next(s for s in found["spans"] if s["label"] == label and s["coverage"] == 1.0)
    assert span["end"] - span["start"] == len(licenses.words(notice))
    words = notice.split()
    if len(words) > 30:
        changed = words[:10] + ["Copyright", "2020", "Somebody"] + words[10:25] + words[27:]
        assert label in licenses.scan_text(" ".join(changed))["labels"].split(",")


def test_scattered_words_are_no_notice():
    words = licenses.NOTICES[0][1].split()
    random.seed(1)
    random.shuffle(words)
    assert licenses.scan_text(" ".join(words))["labels"] == ""


def test_columns(spark):
    row = licenses.scan(frame(spark, [(1, "Released under the MIT License.", "en", "s", 0)])).first()
    assert (row["base_labels"], row["first_word"], row["last_word"], row["n_base"], row["score"]) == ("mit", 3, 3, 1, 1.0)

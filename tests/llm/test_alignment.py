from __future__ import annotations

import hashlib
import json
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from clickloom.llm import alignment
from tests.llm.conftest import AWKWARD, frame

tokenizers = pytest.importorskip("public_tokenizers")
A_PATH, B_PATH = alignment.default_tokenizers()


@pytest.fixture(scope="module")
def coders():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    with open(A_PATH, encoding="utf-8") as file:
        names = {i: t for t, i in json.load(file)["model"]["vocab"].items()}
    return a, names, sentencepiece.SentencePieceProcessor(model_file=B_PATH)


def tokens(coders, text):
    """Ids and bytes of both tokenizers over the whole text."""
    a, names, b = coders
    byte_of = alignment._byte_of()
    a_ids = a.encode(" " + text, add_special_tokens=False).ids
    b_ids = b.encode(text)
    piece = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    return a_ids, [bytes(byte_of[c] for c in names[i]) for i in a_ids], b_ids, [piece(i) for i in b_ids]


def plain(coders, rows):
    """Token by token, link by link."""
    out, links = [], []
    for doc_id, text in rows:
        a_ids, a_raw, b_ids, b_raw = tokens(coders, text) if text else ([], [], [], [])
        if text and not b"".join(a_raw) == (" " + text).encode() == b"".join(b_raw):
            a_ids, a_raw, b_ids, b_raw = [], [], [], []
        found, groups, i, j, group = Counter(), [], 0, 0, ([], [])
        a_at, b_at = 0, 0
        while i < len(a_ids) and j < len(b_ids):
            found[a_ids[i], b_ids[j]] += 1
            a_end, b_end = a_at + len(a_raw[i]), b_at + len(b_raw[j])
            if a_end <= b_end:
                group[0].append(a_ids[i])
                i, a_at = i + 1, a_end
            if b_end <= a_end:
                group[1].append(b_ids[j])
                j, b_at = j + 1, b_end
            if a_end == b_end:
                groups.append(group)
                group = ([], [])
        text = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        out.append([doc_id, len(a_ids), len(b_ids), len(groups), sum(found.values()), hashlib.sha256(text.encode()).hexdigest() if text else ""])
        links.append(found)
    count = Counter(p for found in links for p in found)
    best = defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    return [
        (*row[:5], sum(k for p, k in found.items() if count[p] == best[p[0]]), sum(k * count[p] for p, k in found.items()), row[5])
        for row, found in zip(out, links, strict=True)
    ]


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


PARTS = [" ", "  ", "\n", "\r\n", "\n\n", "\t ", " \t", "a", "don't", "'s", "É", "é1", "42", "!?", "漢字", "\xa0", "\xa0 ", " x", "𝔘", "\x1c ", "\x85\n", "<|endoftext|>", "<s>", "<0x0A>", "the", " The", ".", "\x00"]


@pytest.mark.parametrize("seed", range(4))
def test_cut_texts_have_the_tokens_of_the_whole(coders, seed):
    rng = random.Random(seed)
    both = alignment.Aligner(A_PATH, B_PATH)
    assert both.cut and both.ranks is not None
    if seed == 3:  # the library of the file itself
        both.ranks = None
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(1, 60))) for _ in range(300)]
    texts += [" ", "\n", "  ", "▁", "a ▁b", "x" * 70_000, " " * 70_000 + "x", "\n" * 5_000]
    want = plain(coders, enumerate(texts))
    n_a, n_b, n_groups, digests, row, pair = both.align(texts)
    assert [w[1] for w in want] == n_a.tolist() and [w[2] for w in want] == n_b.tolist()
    assert [w[3] for w in want] == n_groups.tolist() and [w[7] for w in want] == digests
    assert np.bincount(row, minlength=len(texts)).tolist() == [w[4] for w in want]


def test_a_model_whose_pieces_reach_over_spaces_is_not_cut(coders):
    both = alignment.Aligner(A_PATH, B_PATH)
    both.cut = False
    texts = ["two words", "and\nlines  here", "", None, "▁"]
    want = plain(coders, enumerate(texts))
    n_a, n_b, n_groups, digests, _, _ = both.align(texts)
    assert [(w[1], w[2], w[3], w[7]) for w in want] == list(zip(n_a.tolist(), n_b.tolist(), n_groups.tolist(), digests, strict=True))


@pytest.mark.parametrize("n_docs", [1, 9, 300, 65_536])
def test_bitmaps_and_back(n_docs):
    rng = np.random.default_rng(n_docs)
    held = {}
    for pair in range(30):
        for doc in rng.choice(n_docs, size=min(n_docs, int(rng.integers(1, 1 + n_docs // (1 + pair)) if n_docs > 30 else 1)), replace=False):
            held[pair * 50_000 + 7, int(doc)] = 1 if pair % 3 else int(rng.integers(1, 2_000_000))
    key = np.array([(p << 16) | d for p, d in held], np.int64)
    pair, n, docs, planes = alignment.bitmaps(key, np.array(list(held.values()), np.int64), n_docs)
    which, doc, times = alignment.postings(n, docs, planes)
    assert dict(zip(zip(pair[which].tolist(), doc.tolist(), strict=True), times.tolist(), strict=True)) == held
    assert all(len(d) <= (n_docs + 7) // 8 or len(d) == 2 * k for d, k in zip(docs.to_pylist(), n.tolist(), strict=True))
    # A slice of the columns, as it comes in a batch.
    a, b = len(n) // 3, len(n) // 2 + 1
    which, doc, times = alignment.postings(n[a:b], docs.slice(a, b - a), pa.array(planes.to_pylist()[a:b], pa.binary()))
    assert {(int(pair[a:b][w]), int(d)): int(t) for w, d, t in zip(which, doc, times, strict=True)} == {
        k: v for k, v in held.items() if k[0] in set(pair[a:b].tolist())
    }


@pytest.mark.parametrize("bounds", [{}, {"chunk_docs": 7}, {"chunk_postings": 100}])
def test_equals_link_by_link(spark, coders, small_texts, bounds):
    rows = [(r[0], r[1]) for r in small_texts[:60]] + [(5, "the the the the the end"), (6, "the the the the the end"), (None, "the end")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert result(alignment.scored(docs, A_PATH, B_PATH, **bounds)) == sorted(plain(coders, rows), key=str)


def test_awkward_rows(awkward, empty, spark, coders):
    rows = [(r[0], r[1]) for r in AWKWARD]
    assert result(alignment.scored(awkward, A_PATH, B_PATH)) == sorted(plain(coders, rows), key=str)
    assert alignment.scored(empty, A_PATH, B_PATH).count() == 0
    no_text = frame(spark, [(1, None, "en", "a", 0), (2, "▁", "en", "a", 0)])
    assert {tuple(r)[1:] for r in alignment.scored(no_text, A_PATH, B_PATH).collect()} == {(0, 0, 0, 0, 0, 0, "")}
    kept = alignment.scored(awkward, A_PATH, B_PATH, keep=("doc_id", "size", "n"))
    assert {(r["size"], r["n"]) for r in kept.collect()} == {("own size", "own n")}


def test_remembered_units_are_forgotten(monkeypatch, coders):
    monkeypatch.setattr(alignment, "MAX_UNITS", 20)
    both = alignment.Aligner(A_PATH, B_PATH)
    for k in range(5):
        texts = [f"word{i} of{k} text\n{i * k}" for i in range(15)]
        want = plain(coders, enumerate(texts))
        n_a, _, _, digests, _, _ = both.align(texts)
        assert [(w[1], w[7]) for w in want] == list(zip(n_a.tolist(), digests, strict=True))
        assert len(both.index) <= 100

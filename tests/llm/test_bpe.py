from __future__ import annotations

import hashlib
import random

import pytest

from clickloom.llm import bpe
from tests.llm.conftest import AWKWARD, clashing_kept

tokenizers = pytest.importorskip("public_tokenizers")
PATH, PATTERN = bpe.default_tokenizer()


def whole(text):
    """Ids of a text match by match, without any cutting of ours."""
    import regex

    encoding = bpe._encoding(PATH, PATTERN)
    return [i for m in regex.finditer(PATTERN, text or "") for i in encoding._encode_single_piece(m.group())]


def test_awkward_rows(awkward, empty):
    rows = {(r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.digests(awkward, PATH, PATTERN).collect()}
    want = set()
    for doc_id, text, *_ in AWKWARD:
        ids = whole(text)
        sha = [hashlib.sha256(x).hexdigest() for x in (" ".join(map(str, ids)).encode(), (text or "").encode())]
        want.add((doc_id, len(ids), *sha))
    assert rows == want
    coded = bpe.encode(awkward, PATH, PATTERN, "codes")
    assert coded.columns == [*awkward.columns, "codes"] and clashing_kept(coded)
    assert bpe.digests(empty, PATH, PATTERN).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_cut_texts_have_the_ids_of_the_whole(monkeypatch, seed):
    random.seed(seed)
    monkeypatch.setattr(bpe, "PIECE_CHARS", 20)
    parts = [" ", "  ", "\n", "\t ", "a", "don't", "'s", "''", "É", "é1", "42", "!?", "漢字", " ", " x", "𝔘", "'re", "x'll", "\x1c", "́"]
    for _ in range(300):
        text = "".join(random.choice(parts) for _ in range(random.randint(1, 80)))
        pieces = list(bpe.pieces(text, 20))
        assert "".join(pieces) == text
        assert [i for p in pieces for i in bpe._encoding(PATH, PATTERN).encode_ordinary(p)] == whole(text)
        assert bpe.encode_text(text, PATH, PATTERN) == whole(text)


@pytest.mark.parametrize("tail", ["", "x", " x", "\n", "1"])
def test_runs_too_long_for_the_pattern_engine(tail):
    for unit in (" ", "\n", " \t", "a", "!", "7", "é"):
        text = "start " + unit * (600_000 // len(unit)) + tail
        ids = bpe.encode_text(text, PATH, PATTERN)
        assert bpe._encoding(PATH, PATTERN).decode_bytes(ids) == text.encode()
        if unit in (" ", "\n", " \t"):
            assert ids == whole(text)


def test_decoding_is_of_raw_bytes(spark):
    df = spark.createDataFrame([([i],) for i in range(256)] + [([],)], "ids array<int>")
    rows = bpe.decode(df, PATH, PATTERN).collect()
    encoding = bpe._encoding(PATH, PATTERN)
    assert all(bytes(r["decoded"]) == encoding.decode_bytes(r["ids"]) for r in rows)
    assert any(b"\xff" in bytes(r["decoded"]) for r in rows)


def test_separate_steps_give_the_round_trip(awkward):
    from pyspark.sql import functions as F

    apart = bpe.decode(bpe.encode(awkward, PATH, PATTERN, "codes"), PATH, PATTERN, "codes", "raw")
    both = awkward.select("doc_id", bpe.round_trip(F.col("text"), PATH, PATTERN).alias("r")).select("doc_id", "r.ids", "r.decoded")
    key = lambda rows: sorted(str((r[0], list(r[1]), bytes(r[2]))) for r in rows)
    assert key(apart.select("doc_id", "codes", "raw").collect()) == key(both.collect())

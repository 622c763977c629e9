from __future__ import annotations

import math
import random

import numpy as np
import pyarrow as pa
import pytest

from clickloom.llm import masked_lm as lm
from tests.llm.conftest import AWKWARD, frame


def plain_score(text, known, network):
    """Word by word, with ordinary loops."""
    ids = [lm.PAD] * lm.SIDE + known.encode(lm.split_words(text)).tolist() + [lm.PAD] * lm.SIDE
    total = 0.0
    for at in range(lm.SIDE, len(ids) - lm.SIDE):
        around = [*range(at - lm.SIDE, at), *range(at + 1, at + lm.SIDE + 1)]
        h = np.tanh(sum(network.embed[p][ids[i]].astype(float) for p, i in enumerate(around)) + network.hidden)
        c, w = divmod(ids[at], lm.CLASS_WORDS)
        for logits, picked in ((h @ network.to_class + network.class_bias, c), (h @ network.to_word[c] + network.word_bias[c], w)):
            total += logits[picked] - math.log(sum(math.exp(x) for x in logits))
    return total


@pytest.fixture(scope="module")
def trained(spark, small_sf):
    docs = spark.read.parquet(f"{small_sf}/documents.parquet").limit(60)
    known = lm.vocabulary(docs)
    return docs, known, lm.train(docs, known)


def test_scores_equal_plain_loops(spark, trained):
    docs, known, network = trained
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in lm.score(docs, known, network).collect():
        words = lm.split_words(texts[r["doc_id"]])
        assert r["n_tokens"] == len(words)
        if len(words) < 400:
            assert r["score"] == pytest.approx(plain_score(texts[r["doc_id"]], known, network), rel=1e-4, abs=1e-3)


def test_vocabulary_counts_all_documents(spark, small_sf, monkeypatch):
    from collections import Counter

    monkeypatch.setattr(lm, "MAX_COUNTED", 50)
    docs = spark.read.parquet(f"{small_sf}/documents.parquet")
    want = Counter(w for r in docs.collect() for w in lm.split_words(r["text"]))
    known = lm.vocabulary(docs)
    top = sorted(want.items(), key=lambda x: (-x[1], x[0]))[: lm.SIZE - lm.HASHED]
    assert list(known.ids) == [w for w, _ in top] and known.counts.sum() == pytest.approx(sum(want.values()))


def test_gradient_is_that_of_the_loss():
    random.seed(1)
    start = lm.Network.start(np.arange(lm.SIZE, dtype=float)).flat
    context = np.array([[random.randint(0, lm.SIZE) for _ in range(40)] for _ in range(2 * lm.SIDE)])
    words = np.array([random.randint(0, lm.SIZE - 1) for _ in range(40)])
    network = lm.Network(start.astype(np.float64))
    before = network.flat.copy()
    slope = network.gradient(context, words).flat
    loss = lambda flat: -lm.Network(flat).log_probabilities(context, words).mean()
    places = np.argsort(-np.abs(slope))[::50][:25]
    for at in places:
        up, down = before.copy(), before.copy()
        up[at] += 1e-4
        down[at] -= 1e-4
        assert slope[at] == pytest.approx((loss(up) - loss(down)) / 2e-4, rel=2e-2, abs=1e-6)


def test_training_uses_both_sides(spark):
    """The middle word repeats its right neighbour: only a model that sees the right side can know it."""
    random.seed(2)
    rows = []
    for i in range(400):
        words = []
        for _ in range(60):
            w = f"w{random.randint(0, 30)}"
            words += ["of", w, w]
        rows.append((i, " ".join(words), "en", "s", 0))
    docs = frame(spark, rows, False)
    known = lm.vocabulary(docs)
    total = lambda network: lm.score(docs, known, network).groupBy().sum("score").first()[0] / (400 * 180)
    unigram, few, many = (total(lm.train(docs, known, n)) for n in (0, 2, 12))
    assert unigram < few < many and many > unigram + 0.3


def test_sums_follow_documents_in_a_batch(trained):
    _, known, network = trained
    texts = ["", None, "the of and", "x", "", "the the the the"]
    n, total = lm.scores_of(pa.array(texts), known, network)
    assert n.tolist() == [0, 0, 3, 1, 0, 4]
    for t, s in zip(texts, total, strict=True):
        assert s == pytest.approx(plain_score(t, known, network), rel=1e-4, abs=1e-5)


def test_awkward_rows(awkward, empty):
    rows = lm.score_corpus(awkward).collect()
    assert len(rows) == len(AWKWARD)
    by_id = {r["doc_id"]: r for r in rows}
    assert all((by_id[i]["n_tokens"], by_id[i]["score"], by_id[i]["mean_score"]) == (0, 0.0, None) for i in (1, 2, 3))
    assert by_id[7]["score"] < 0 and math.isfinite(by_id[7]["score"])
    assert len({r["score"] for r in rows if r["doc_id"] == 5}) == 1
    assert lm.score_corpus(empty).count() == 0


def test_hashed_ids_are_those_of_spark(spark):
    from pyspark.sql import functions as F

    words = [f"word{i}" * (i % 9 + 1) for i in range(300)]
    of = F.pmod(F.xxhash64(F.col("w").cast("binary")), F.lit(lm.HASHED))
    rows = spark.createDataFrame([(w,) for w in words], "w string").select("w", of.alias("of")).collect()
    assert all(lm.hashed_id(r["w"].encode()) == lm.SIZE - lm.HASHED + r["of"] for r in rows)


@pytest.mark.parametrize("most", [0, 1500, 10**6])
def test_scores_are_those_of_words_and_not_of_hashed_ids(spark, monkeypatch, most):
    """Every word outside the vocabulary takes its own share of its id, wherever its count comes from."""
    from collections import Counter

    monkeypatch.setattr(lm, "KNOWN", most)
    random.seed(3)
    names = [f"w{i}" for i in range(4000)]
    rows = [(i, " ".join(random.choices(names, [1 / (k + 5) for k in range(4000)], k=120)), "en", "s", 0) for i in range(200)]
    rows += [(200, None, "en", "s", 0), (None, rows[0][1], "en", "s", 0), (3, rows[3][1], "en", "s", 0)]
    rows += [(201, "w1 w2 qzxv w3 w4", "en", "s", 0)]
    docs = frame(spark, rows, False)
    n = Counter(w for r in rows for w in lm.split_words(r[1]))
    counted = lm.word_counts(docs)
    known = lm.vocabulary(docs, counted)
    assert len(n) > len(known.ids) + 500 and len(known.places) <= max(most, len(known.ids))
    totals = Counter()
    for w in n.keys() - known.ids.keys():
        totals[lm.hashed_id(w)] += n[w]
    assert {i: known.counts[i] for i in totals} == totals
    network = lm.train(docs, known, 1)
    share = lambda w: 0.0 if w in known.ids else math.log(max(n[w], 1) / (totals[lm.hashed_id(w)] + 1))
    others = [*rows, (301, "w1 w2 w3999 neverseen w4 neverseen", "en", "s", 0)]
    got = lm.word_scores(frame(spark, others, False), known, network, counted).collect()
    want = [(r[0], plain_score(r[1], known, network) + sum(map(share, lm.split_words(r[1])))) for r in others]
    order = lambda x: (str(x[0]), x[1])
    for (a, x), (b, y) in zip(sorted(((r["doc_id"], r["score"]) for r in got), key=order), sorted(want, key=order), strict=True):
        assert a == b and x == pytest.approx(y, rel=1e-4, abs=1e-3)
    whole = {r["doc_id"]: r["score"] for r in lm.score_corpus(docs).collect()}
    ids_only = {r["doc_id"]: r["score"] for r in lm.score(docs, known, network).collect()}
    assert whole[201] < ids_only[201] - 1


def test_rounds_train_on_every_word_once(spark, monkeypatch):
    """However the documents are dealt to tasks and batches, the rounds of a training have each word as target once."""
    rows = [(i, " ".join(f"t{i}x{j}" for j in range(i % 7)), "en", "s", 0) for i in range(60)]
    known = lm.vocabulary(frame(spark, rows, False))
    assert len(known.ids) == sum(i % 7 for i in range(60))
    met, asked = [], []
    texts = [r[1] for r in rows]
    for number in range(lm.ROUNDS):
        for part in (texts[:11], texts[11:12], texts[12:]):
            at, laid = lm._targets(pa.array(part), known, number % lm.STRIDE)
            met += laid[at].tolist()
    assert sorted(met) == list(range(len(known.ids)))
    trainer = lm._trainer
    monkeypatch.setattr(lm, "_trainer", lambda shared, phase: asked.append(phase) or trainer(shared, phase))
    lm.train(frame(spark, rows, False), known)
    assert asked == list(range(lm.STRIDE))

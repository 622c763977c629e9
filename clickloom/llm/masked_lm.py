"""Document scores by masked pseudo-likelihood.

A small network predicts every word from the two words on each side of it. A document's score is the sum over its
words of ``log p(word | words on both sides)``.

Vocabulary: words are counted over all documents; the most frequent ones get an id, the others one of a few hashed
ids. The probability of a word with a hashed id is that of the id times the word's share ``n / (N + 1)`` of it: n counts
the word, N all words of the id, and the 1 is left for words that were not counted. Counts of the ``KNOWN`` most frequent
words are with each task; those of the others are joined with the documents' words. Network: one embedding table per place of the window, their sum through tanh, then a two-level softmax (class of
32 words, word of the class), so a prediction costs 64 outputs and not 1,024. The biases start at the counts, so
training starts from the unigram model.

Documents are encoded once, to 16-bit ids, and every later pass reads these.

Training: in each round every task starts from the shared weights and runs Adagrad steps over every ``STRIDE``-th
word of all its documents, from another first word in each round, so that the rounds together train on every word; what
changed, times the words trained on, is summed slice by slice across tasks and averaged.
What is gathered grows with the number of tasks; what reaches the driver is one set of weights.

Edge cases: null or empty text has no words and score 0 (mean null); long texts are predicted in slices with their
whole context; repeated rows get equal scores; an empty table gives an empty result. Only ``doc_id`` and ``text`` are
read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickloom.llm.common import documents, register, write_and_read

SIDE = 2  # words of context on each side
DIM = 32
CLASSES, CLASS_WORDS = 32, 32
SIZE = CLASSES * CLASS_WORDS
HASHED = 64  # ids shared by the words outside the vocabulary
PAD = SIZE
ROUNDS, STRIDE = 2, 2  # as many rounds as the stride: each word is a target once
BATCH, RATE, FIRST_SQUARE = 4096, 0.15, 1e-6
SLICE_WORDS = 8192  # words predicted at once
MAX_COUNTED = 200_000  # distinct words a task counts before it sends them on
SLICE_WEIGHTS = 16_384
KNOWN = 65_536  # words whose counts every task holds
COUNT_STEPS = 16  # steps of the counts' histogram that a doubling takes
FIXED = 2**30  # logs of joined counts are summed as multiples of 1 / FIXED, so that their order does not matter
HASH_SEED = 42  # that of Spark's xxhash64
SEED = 7

Batches = Iterator[pa.RecordBatch]


def split_words(text: str | None) -> list[bytes]:
    return text.encode().lower().split() if text else []


def _count(batches: Batches) -> Batches:
    counts: Counter = Counter()

    def sent() -> pa.RecordBatch:
        words, n = pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())
        return pa.RecordBatch.from_arrays([words, n], ["word", "n"])

    for batch in batches:
        for text in batch.column("text"):
            counts.update(split_words(text.as_py()))
            if len(counts) > MAX_COUNTED:
                yield sent()
                counts.clear()
    if counts:
        yield sent()


@dataclass
class Vocabulary:
    ids: dict[bytes, int]
    counts: np.ndarray  # of each id, over the corpus
    places: dict[bytes, int]  # of the words with ids, then of other frequent ones, in the two arrays
    place_ids: np.ndarray
    place_logs: np.ndarray  # log of the share of the id
    first_step: int  # counts below this step of their histogram are not here

    def encode(self, words: list[bytes]) -> np.ndarray:
        return self.encode_shares(words)[0]

    def encode_shares(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Ids, logs of the words' shares of them, and the words that are not in ``places``: their logs lack that of the count."""
        at = np.fromiter(map(self.places.get, words, repeat(-1)), np.int32, len(words))
        ids, logs = self.place_ids[at], self.place_logs[at]
        unknown = np.flatnonzero(at < 0)
        rare = [words[i] for i in unknown.tolist()]
        if rare:
            ids[unknown] = [hashed_id(w) for w in rare]
            logs[unknown] = -np.log(self.counts[ids[unknown]] + 1)
        return ids, logs, rare


def hashed_id(word: bytes) -> int:
    return SIZE - HASHED + xxhash.xxh64_intdigest(word, HASH_SEED) % HASHED


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n): all words of all documents, written."""
    counted = docs.select("text").mapInArrow(_count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return write_and_read(counted, "lm-words")


def _step() -> Column:
    return F.floor(F.log2(F.col("n").cast("double")) * COUNT_STEPS).cast("int")


def _first_known(counted: DataFrame) -> int:
    """The lowest step of the counts' histogram from which on there are at most KNOWN words."""
    steps = counted.groupBy(_step().alias("step")).count().orderBy(F.desc("step")).collect()  # at most 64 COUNT_STEPS rows
    lowest, total = 64 * COUNT_STEPS, 0
    for r in steps:
        total += r["count"]
        if total > KNOWN:
            break
        lowest = r["step"]
    return lowest


def vocabulary(docs: DataFrame, counted: DataFrame | None = None) -> Vocabulary:
    """The most frequent words of all documents, the totals of the hashed ids, and the shares of further frequent words."""
    counted = word_counts(docs) if counted is None else counted
    top = counted.orderBy(F.desc("n"), "word").limit(SIZE - HASHED).collect()
    ids = {bytes(r["word"]): i for i, r in enumerate(top)}
    counts = np.zeros(SIZE)
    for r in counted.groupBy(F.pmod(F.xxhash64("word"), F.lit(HASHED)).alias("of")).agg(F.sum("n").alias("n")).collect():
        counts[SIZE - HASHED + r["of"]] = r["n"]
    for i, r in enumerate(top):
        counts[i] = r["n"]
        counts[hashed_id(bytes(r["word"]))] -= r["n"]
    first_step = _first_known(counted)
    further = counted.filter(_step() >= first_step).collect()  # at most KNOWN rows
    further = sorted((-r["n"], bytes(r["word"])) for r in further if bytes(r["word"]) not in ids)
    words = [*ids, *[w for _, w in further]]
    place_ids = np.array([*range(len(ids)), *[hashed_id(w) for _, w in further], PAD], np.int32)  # the last is that of no place
    place_logs = np.zeros(len(place_ids))
    n = np.array([-n for n, _ in further], np.float64)
    place_logs[len(ids) : -1] = np.log(n) - np.log(counts[place_ids[len(ids) : -1]] + 1)
    return Vocabulary(ids, counts, {w: i for i, w in enumerate(words)}, place_ids, place_logs, first_step)


class Network:
    """Weights as one flat array with views of its parts."""

    SHAPES = {
        "embed": (2 * SIDE, SIZE + 1, DIM),
        "hidden": (DIM,),
        "to_class": (DIM, CLASSES),
        "class_bias": (CLASSES,),
        "to_word": (CLASSES, DIM, CLASS_WORDS),
        "word_bias": (CLASSES, CLASS_WORDS),
    }
    LENGTH = sum(int(np.prod(s)) for s in SHAPES.values())

    def __init__(self, flat: np.ndarray):
        self.flat = flat
        at = 0
        for name, shape in self.SHAPES.items():
            n = int(np.prod(shape))
            setattr(self, name, flat[at : at + n].reshape(shape))
            at += n

    @classmethod
    def start(cls, counts: np.ndarray) -> Network:
        network = cls(np.zeros(cls.LENGTH, np.float32))
        random = np.random.default_rng(SEED)
        for part in (network.embed, network.to_class, network.to_word):
            part[:] = random.normal(0, 0.1, part.shape)
        share = (counts + 1).reshape(CLASSES, CLASS_WORDS)
        network.class_bias[:] = np.log(share.sum(axis=1) / share.sum())
        network.word_bias[:] = np.log(share / share.sum(axis=1, keepdims=True))
        return network

    def _hidden(self, context: np.ndarray) -> np.ndarray:
        total = np.take(self.embed[0], context[0], axis=0)
        for place in range(1, 2 * SIDE):
            total += np.take(self.embed[place], context[place], axis=0)
        total += self.hidden
        return np.tanh(total, out=total)

    def log_probabilities(self, context: np.ndarray, words: np.ndarray) -> np.ndarray:
        """log p of each word given its context (one row a place)."""
        order, edges, of, within = _by_class(words)
        h = self._hidden(context[:, order])
        logs = _log_picked(h @ self.to_class + self.class_bias, of)
        for c in range(CLASSES):
            a, b = edges[c], edges[c + 1]
            if a < b:
                logs[a:b] += _log_picked(h[a:b] @ self.to_word[c] + self.word_bias[c], within[a:b])
        out = np.empty_like(logs)
        out[order] = logs
        return out

    def gradient(self, context: np.ndarray, words: np.ndarray) -> Network:
        """Gradient of the mean loss of a batch, laid out like the weights."""
        n = len(words)
        # Words of one class lie together, so that each class is one product over a slice.
        order, edges, of, within = _by_class(words)
        context = context[:, order]
        h = self._hidden(context)
        out = Network(np.zeros(self.LENGTH, self.flat.dtype))
        error = _softmax_error(h @ self.to_class + self.class_bias, of)
        back = error @ self.to_class.T
        out.to_class[:], out.class_bias[:] = h.T @ error, error.sum(axis=0)
        for c in range(CLASSES):
            a, b = edges[c], edges[c + 1]
            if a < b:
                e = _softmax_error(h[a:b] @ self.to_word[c] + self.word_bias[c], within[a:b])
                back[a:b] += e @ self.to_word[c].T
                out.to_word[c], out.word_bias[c] = h[a:b].T @ e, e.sum(axis=0)
        back *= 1 - h * h
        for place in range(2 * SIDE):
            ids = context[place].astype(np.uint16)
            order = np.argsort(ids, kind="stable")
            ids = ids[order]
            first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
            out.embed[place][ids[first]] = np.add.reduceat(np.take(back, order, axis=0), first, axis=0)
        out.hidden[:] = back.sum(axis=0)
        out.flat /= n
        return out

    def step(self, context: np.ndarray, words: np.ndarray, squares: np.ndarray) -> None:
        """One step of Adagrad; ``squares`` are the sums of squared gradients so far."""
        change = self.gradient(context, words).flat
        squares += change * change
        change /= np.sqrt(squares)
        change *= RATE
        self.flat -= change


def _log_picked(x: np.ndarray, picked: np.ndarray) -> np.ndarray:
    """Log-softmax of one column a row."""
    x -= x.max(axis=1, keepdims=True)
    chosen = x[np.arange(len(x)), picked]
    return chosen - np.log(np.exp(x, out=x).sum(axis=1))


def _softmax_error(x: np.ndarray, picked: np.ndarray) -> np.ndarray:
    """Softmax less one at the given column of each row: the slope of the loss."""
    x -= x.max(axis=1, keepdims=True)
    np.exp(x, out=x)
    x /= x.sum(axis=1, keepdims=True)
    x[np.arange(len(x)), picked] -= 1
    return x


def _by_class(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Order of the words by class, where each class starts in it, and class and place within it of the ordered words."""
    of = (words // CLASS_WORDS).astype(np.uint8)  # bytes sort in one pass
    order = np.argsort(of, kind="stable")
    of = of[order]
    return order, np.searchsorted(of, np.arange(CLASSES + 1)), of, words[order] % CLASS_WORDS


def _laid(documents: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of several documents in one array with pads between them; start and length of each document."""
    gap = np.full(SIDE, PAD, np.uint16)
    lengths = np.fromiter(map(len, documents), np.int64, len(documents))
    starts = SIDE + np.cumsum(lengths + SIDE) - lengths - SIDE
    parts = [gap]
    for ids in documents:
        parts += [ids, gap]
    return np.concatenate(parts), starts, lengths


def _laid_out(texts: pa.Array, known: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return _laid([known.encode(split_words(t.as_py())).astype(np.uint16) for t in texts])


def _ids(column: pa.Array) -> list[np.ndarray]:
    """Ids of each document of an encoded batch."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    return [data[a:b].view(np.uint16) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]


def encoded(docs: DataFrame, known: Vocabulary) -> DataFrame:
    """Words as 16-bit ids, once for all passes: doc_id, row, ids, the summed logs of the words' shares, words without a count."""
    shared = docs.sparkSession.sparkContext.broadcast(known)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Batches) -> Batches:
        vocabulary = shared.value
        for batch in batches:
            ids, sums, rare, times, ends = [], [], [], [], [0]
            for text in batch.column("text"):
                own, logs, unknown = vocabulary.encode_shares(split_words(text.as_py()))
                ids.append(own.astype(np.uint16).tobytes())
                sums.append(logs.sum())
                found = Counter(unknown)
                rare += found.keys()
                times += found.values()
                ends.append(len(rare))
            offsets = pa.array(ends, pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x, kind)) for x, kind in ((rare, pa.binary()), (times, pa.int32()))]
            columns = [batch.column("doc_id"), pa.array(ids, pa.binary()), pa.array(sums, pa.float64()), *lists]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "shares", "rare", "times"])

    schema = f"doc_id {id_type}, ids binary, shares double, rare array<binary>, times array<int>"
    # Written, so that the rows keep their numbers.
    return write_and_read(docs.select("doc_id", "text").mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id()), "lm-encoded")


def _contexts(laid: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.stack([laid[at + shift] for shift in (*range(-SIDE, 0), *range(1, SIDE + 1))])


def _targets(texts: pa.Array, known: Vocabulary, phase: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of every ``STRIDE``-th word of each document, from word ``phase`` on, and the words laid out."""
    return _every(*_laid_out(texts, known), phase)


def _every(laid: np.ndarray, starts: np.ndarray, lengths: np.ndarray, phase: int) -> tuple[np.ndarray, np.ndarray]:
    words = np.flatnonzero(laid != PAD)
    return words[(words - np.repeat(starts, lengths)) % STRIDE == phase], laid


def _trainer(shared, phase: int):
    """Run gradient steps over a task's documents and send what changed (weights and squares), slice by slice."""

    def run(batches: Batches) -> Batches:
        state = shared.value
        mine, trained = state.copy(), 0
        network, squares = Network(mine[: Network.LENGTH]), mine[Network.LENGTH :]
        waiting: list[np.ndarray] = []

        def train(rows: np.ndarray) -> None:
            for i in range(0, rows.shape[1], BATCH):
                part = rows[:, i : i + BATCH]
                network.step(part[:-1], part[-1], squares)

        for batch in batches:
            at, laid = _every(*_laid(_ids(batch.column("ids"))), phase)
            if len(at):
                waiting.append(np.vstack([_contexts(laid, at), laid[at][None]]))
                trained += len(at)
            if sum(w.shape[1] for w in waiting) >= 8 * BATCH:
                train(np.hstack(waiting))
                waiting = []
        if waiting:
            train(np.hstack(waiting))
        if trained:
            change = (mine - state).astype(np.float64) * trained
            slices = range(0, len(state), SLICE_WEIGHTS)
            yield pa.RecordBatch.from_pydict(
                {
                    "slice": pa.array(range(len(slices)), pa.int32()),
                    "task": pa.array([TaskContext.get().partitionId()] * len(slices), pa.int32()),
                    "n": pa.array([trained] * len(slices), pa.int64()),
                    "change": pa.array([change[i : i + SLICE_WEIGHTS].astype(np.float32).tobytes() for i in slices], pa.binary()),
                }
            )

    return run


def _sum_changes(batches: Batches) -> Batches:
    """Rows come sorted by slice and task; one row a slice goes out."""
    current, total, words = None, None, 0

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(
            {"slice": pa.array([current], pa.int32()), "n": pa.array([words], pa.int64()), "change": pa.array([total.tobytes()], pa.binary())}
        )

    for batch in batches:
        for number, n, change in zip(batch.column("slice"), batch.column("n"), batch.column("change"), strict=True):
            if number.as_py() != current:
                if current is not None:
                    yield done()
                current, total, words = number.as_py(), 0.0, 0
            total = total + np.frombuffer(change.as_py(), np.float32).astype(np.float64)
            words += n.as_py()
    if current is not None:
        yield done()


def train(docs: DataFrame, known: Vocabulary, rounds: int = ROUNDS) -> Network:
    return train_encoded(encoded(docs, known), known, rounds)


def train_encoded(corpus: DataFrame, known: Vocabulary, rounds: int = ROUNDS) -> Network:
    spark, ids = corpus.sparkSession, corpus.select("ids")
    state = np.concatenate([Network.start(known.counts).flat, np.full(Network.LENGTH, FIRST_SQUARE, np.float32)])
    for number in range(rounds):
        shared = spark.sparkContext.broadcast(state)
        sent = ids.mapInArrow(_trainer(shared, number % STRIDE), "slice int, task int, n long, change binary")
        summed = sent.repartition("slice").sortWithinPartitions("slice", "task").mapInArrow(_sum_changes, "slice int, n long, change binary")
        state = state.copy()
        for row in summed.collect():  # weights and squares once
            start = row["slice"] * SLICE_WEIGHTS
            state[start : start + SLICE_WEIGHTS] += (np.frombuffer(row["change"], np.float64) / row["n"]).astype(np.float32)
    return Network(state[: Network.LENGTH])


def _totals(laid: np.ndarray, starts: np.ndarray, lengths: np.ndarray, network: Network) -> np.ndarray:
    """Summed log-probability of the words of each document."""
    at = np.flatnonzero(laid != PAD)
    logs = np.zeros(len(laid))
    for i in range(0, len(at), SLICE_WORDS):
        part = at[i : i + SLICE_WORDS]
        logs[part] = network.log_probabilities(_contexts(laid, part), laid[part])
    # Pads count 0, so a document's sum may run up to the start of the next one.
    totals = np.add.reduceat(logs, starts) if len(starts) else np.empty(0)
    return np.where(lengths > 0, totals, 0.0)


def scores_of(texts: pa.Array, known: Vocabulary, network: Network) -> tuple[np.ndarray, np.ndarray]:
    """Number of words and summed log-probability of each text."""
    laid, starts, lengths = _laid_out(texts, known)
    return lengths, _totals(laid, starts, lengths, network)


def _scored(corpus: DataFrame, network: Network) -> DataFrame:
    """Encoded documents (without ids) with n_tokens and the score of their ids."""
    shared = corpus.sparkSession.sparkContext.broadcast(network.flat)
    kept = [c for c in corpus.columns if c != "ids"]
    types = ", ".join(f"{c} {corpus.schema[c].dataType.simpleString()}" for c in kept)

    def run(batches: Batches) -> Batches:
        model = Network(shared.value)
        for batch in batches:
            laid, starts, lengths = _laid(_ids(batch.column("ids")))
            totals = _totals(laid, starts, lengths, model)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(lengths), pa.array(totals)], [*kept, "n_tokens", "score"])

    return corpus.select(*kept, "ids").mapInArrow(run, f"{types}, n_tokens long, score double")


def _with_mean(scored: DataFrame) -> DataFrame:
    return scored.select("doc_id", "n_tokens", "score").withColumn("mean_score", F.try_divide("score", F.col("n_tokens")))


def score(docs: DataFrame, known: Vocabulary, network: Network) -> DataFrame:
    """(doc_id, n_tokens, score, mean_score), one row per document; the score is that of the words' ids."""
    return _with_mean(_scored(encoded(docs, known).select("doc_id", "ids"), network))


def word_scores(docs: DataFrame, known: Vocabulary, network: Network, counted: DataFrame) -> DataFrame:
    """As ``score``, with the probabilities of the words instead of those of their ids."""
    return word_scores_encoded(encoded(docs, known), known, network, counted)


def word_scores_encoded(corpus: DataFrame, known: Vocabulary, network: Network, counted: DataFrame) -> DataFrame:
    rare = corpus.select("row", F.explode(F.arrays_zip("rare", "times")).alias("of")).select("row", "of.rare", "of.times")
    # Words that occur once, or that were not counted, add nothing.
    counts = counted.filter((F.col("n") > 1) & (_step() < known.first_step))
    counts = counts.select(F.col("word").alias("rare"), F.round(F.log("n") * FIXED).cast("long").alias("log"))
    more = rare.join(counts, "rare").groupBy("row").agg(F.sum(F.col("times") * F.col("log")).alias("more"))
    scored = _scored(corpus.select("doc_id", "row", "shares", "ids"), network).join(more, "row", "left")
    more = F.coalesce(F.col("more") / F.lit(float(FIXED)), F.lit(0.0))
    return _with_mean(scored.withColumn("score", F.col("score") + F.col("shares") + more))


def score_corpus(docs: DataFrame) -> DataFrame:
    """Train on the corpus and score it."""
    counted = word_counts(docs)
    known = vocabulary(docs, counted)
    corpus = encoded(docs, known)
    return word_scores_encoded(corpus, known, train_encoded(corpus, known), counted)


@register("op7_masked_lm_score")
def op7_masked_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_corpus(documents(spark, sf_dir))

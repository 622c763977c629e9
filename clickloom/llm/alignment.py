"""Alignment of two tokenizers over the same bytes, scored with inverted pair bitmaps.

Tokenizer A is a byte-level BPE (a ``tokenizers`` file), B a piece model (a ``sentencepiece`` file); both paths must be
readable on every executor. Both encode a space and the text. Byte offsets where tokens of both end cut them into groups,
and an A and a B token are linked where their byte ranges overlap.

Texts are cut before white space that follows a visible character: there a match of A's pattern ends, and no piece of B
reaches beyond it (looked up in the piece table; for another model texts are not cut). So the units, mostly a space and
a word, are aligned once for each worker and remembered, within bounds.

Counting works on inverted lists. Documents are numbered within chunks, and for each id pair a task makes a bitmap of the
documents of its chunk that hold it linked: document numbers, or bits where these are shorter. Batches are
merged into the chunk's bitmaps, which are disjoint between chunks, so the merged bitmap of a pair has as
many documents as its parts. Where a document holds a pair more than once, bit planes over the bitmap's documents give
the binary digits of the number of links. Pairs are counted from the bitmaps' sizes, the best pairs of each A id are
marked, and the postings take the scores back to their chunk, where they are added up for each document.

Bounds. A chunk ends at ``CHUNK_DOCS`` documents or after ``CHUNK_POSTINGS`` postings; a task holds one chunk, one batch of
texts and the remembered units. A pair has one row a chunk, so the most frequent pair is combined before the
shuffle like any other. Everything read later comes from the table written by the one pass that encodes.

Edge cases: null and empty texts, and texts whose tokens do not give back their bytes (U+2581 in a text does this) have
no tokens: zeros and an empty digest; very long texts are whole, in a chunk of their own if need be; ties for the highest
count are all best; repeated rows, also of one id, count as documents each; empty tables give empty results; other
columns are not read and may have any name.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from clickloom.llm.common import documents, register, write_and_read
from clickloom.session import new_folder

CHUNK_DOCS = 1 << 16
CHUNK_POSTINGS = 8 << 20
MAX_UNITS, MAX_UNIT_TOKENS = 300_000, 4 << 20  # units and tokens of units that a worker remembers

_SPACE = " \t\n"
_UNIT = re.compile(r"[ \t\n]*[^ \t\n]+|[ \t\n]+")
# The pattern that byte-level files mean where they ask for one (fixed value), and units too long for its other engine.
_BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LONG_UNIT = 10_000
# Other white space before one of these: A's pattern may take both together, so the text is not cut.
_OTHER = re.compile(r"[^\S \t\n][ \t\n]")

_ROWS = (
    "posting boolean, chunk long, doc int, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "pair long, n long, docs binary, planes binary"
)
_ROW_TYPES = [
    pa.field("posting", pa.bool_()), pa.field("chunk", pa.int64()), pa.field("doc", pa.int32()), pa.field("n_a", pa.int64()),
    pa.field("n_b", pa.int64()), pa.field("n_groups", pa.int64()), pa.field("n_links", pa.int64()),
    pa.field("groups_sha256", pa.string()), pa.field("pair", pa.int64()), pa.field("n", pa.int64()),
    pa.field("docs", pa.binary()), pa.field("planes", pa.binary()),
]


def _byte_of() -> dict[str, int]:
    """Byte of each character of a byte-level vocabulary: visible Latin-1 stands for itself, the rest follows U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class _Grown:
    """An array that grows at its end."""

    def __init__(self, dtype):
        self.held, self.size = np.empty(1024, dtype), 0

    def add(self, values) -> None:
        need = self.size + len(values)
        if need > len(self.held):
            self.held = np.concatenate([self.held[: self.size], np.empty(max(need, self.size), self.held.dtype)])
        self.held[self.size : need] = values
        self.size = need

    @property
    def all(self) -> np.ndarray:
        return self.held[: self.size]


def _by_rank(content: dict, names: list[bytes]):
    """The same tokenizer for short texts, several times as fast, where merges are made in the order of their ids; else None."""
    import tiktoken

    model, before = content["model"], content["pre_tokenizer"] or {}
    plain = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    level = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
    if not plain or not level or content["normalizer"]:
        return None
    special = {t["id"] for t in content["added_tokens"]}
    made = []
    for merge in model["merges"]:
        left, right = merge.split(" ") if isinstance(merge, str) else merge
        made.append(model["vocab"][left + right])
    ranks = {name: i for i, name in enumerate(names) if name and i not in special}
    if made != sorted(set(made)) or len(ranks) != 256 + len(made):
        return None
    return tiktoken.Encoding("ranks", pat_str=_BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})


class Aligner:
    """Both tokenizers and the units aligned so far."""

    def __init__(self, a_path: str, b_path: str):
        # A task has one core.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        byte_of = _byte_of()
        with open(a_path, encoding="utf-8") as file:
            content = json.load(file)
        vocabulary = content["model"]["vocab"]
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            if all(c in byte_of for c in token):
                self.a_bytes[i] = bytes(byte_of[c] for c in token)
        self.ranks = _by_rank(content, self.a_bytes)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        # A piece that has a space behind another character, or other white space, would reach over a cut.
        ordinary = [p for i, p in enumerate(pieces) if not self.b.is_byte(i)]
        self.cut = not any("▁" in p.lstrip("▁") or any(c in p for c in _SPACE) for p in ordinary)
        self.cut = self.cut and len(self.b.encode("a")) == 1
        self.pairs_an_a = len(pieces)
        self.a_size = np.array([len(t) for t in self.a_bytes], np.int64)
        self.b_size = np.array([len(t) for t in self.b_bytes], np.int64)
        # Texts of an id within its group, at the end of its side and (B) at the end of its unit.
        self.a_text = [f"{i}," for i in range(len(self.a_bytes))] + [f"{i}|" for i in range(len(self.a_bytes))]
        self.b_text = [f"{i}{end}" for end in (",", ";", ";\n") for i in range(len(pieces))]
        self.texts = self.a_text + self.b_text
        self._forget()

    def _forget(self) -> None:
        self.index: dict[str, int] = {}
        self.text: list[str] = []
        self.n_a, self.n_b, self.n_groups = _Grown(np.int64), _Grown(np.int64), _Grown(np.int64)  # n_a is -1 where bytes differ
        self.start, self.pairs = _Grown(np.int64), _Grown(np.int64)

    def units(self, text: str) -> list[str]:
        """A space and the text, cut where both tokenizers start anew."""
        text = " " + text
        return _UNIT.findall(text) if self.cut and not _OTHER.search(text) else [text]

    def _a_ids(self, units: list[str]) -> list[list[int]]:
        if self.ranks is None:
            return [e.ids for e in self.a.encode_batch_fast(units, add_special_tokens=False)]
        encode = self.ranks.encode_ordinary
        long = lambda u: self.a.encode(u, add_special_tokens=False).ids
        return [encode(u) if len(u) < LONG_UNIT else long(u) for u in units]

    def _b_ids(self, units: list[str]) -> list[list[int]]:
        if self.cut:  # behind a visible character, so that the model adds no space; its one token goes
            return [ids[1:] for ids in self.b.encode(["a" + u for u in units], num_threads=1)]
        return self.b.encode([u[1:] for u in units], num_threads=1)

    def _same(self, units: list[str], a_ids: list[list[int]], b_ids: list[list[int]]) -> np.ndarray:
        """Units whose tokens give back their bytes on both sides."""
        whole = "".join(units).encode()
        if all(b"".join(map(names.__getitem__, chain.from_iterable(ids))) == whole for names, ids in ((self.a_bytes, a_ids), (self.b_bytes, b_ids))):
            sizes = np.fromiter((len(u) if u.isascii() else len(u.encode()) for u in units), np.int64, len(units))
            if all((_sums(size[_flat(ids)], _lengths(ids)) == sizes).all() for size, ids in ((self.a_size, a_ids), (self.b_size, b_ids))):
                return np.ones(len(units), bool)
        return np.array(
            [
                b"".join(map(self.a_bytes.__getitem__, a)) == unit.encode() == b"".join(map(self.b_bytes.__getitem__, b))
                for unit, a, b in zip(units, a_ids, b_ids, strict=True)
            ],
            bool,
        )

    def learn(self, units: list[str]) -> None:
        """Align units that are new."""
        a_ids, b_ids = self._a_ids(units), self._b_ids(units)
        good = self._same(units, a_ids, b_ids)
        if not good.all():
            a_ids, b_ids = ([x if same else [] for x, same in zip(ids, good.tolist(), strict=True)] for ids in (a_ids, b_ids))
        a, b, n_a, n_b = _flat(a_ids), _flat(b_ids), _lengths(a_ids), _lengths(b_ids)
        # All units one after the other: both tokenizers have the same number of bytes in each.
        a_end, b_end = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        ends = np.union1d(a_end, b_end)
        self.pairs.add(a[np.searchsorted(a_end, ends)] * self.pairs_an_a + b[np.searchsorted(b_end, ends)])
        a_last, b_last = np.isin(a_end, b_end, assume_unique=True), np.isin(b_end, a_end, assume_unique=True)
        n_groups = _sums(a_last.astype(np.int64), n_a)
        n_links = n_a + n_b - n_groups
        first = self.start.all[-1] + self.last_links if self.start.size else 0
        self.start.add(first + np.cumsum(n_links) - n_links)
        self.last_links = int(n_links[-1])
        self.n_a.add(np.where(good, n_a, -1))
        self.n_b.add(n_b)
        self.n_groups.add(n_groups)
        self.index.update(zip(units, range(len(self.index), len(self.index) + len(units)), strict=True))
        # Group by group, A's ids and then B's: a token's place is after all tokens of both sides in earlier groups.
        a_group, b_group = np.cumsum(a_last) - a_last, np.cumsum(b_last) - b_last
        in_a, in_b = np.bincount(a_group, minlength=1), np.bincount(b_group, minlength=1)
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + (np.cumsum(in_b) - in_b)[a_group]] = a + len(self.a_bytes) * a_last
        closes = np.zeros(len(b), np.int64)
        closes[np.cumsum(n_b)[n_b > 0] - 1] = 1
        order[np.arange(len(b)) + np.cumsum(in_a)[b_group]] = len(self.a_text) + b + len(self.b_bytes) * (b_last + closes)
        texts = iter("".join(map(self.texts.__getitem__, order.tolist())).split("\n"))
        self.text += [next(texts) if same else "" for same in (n_b > 0).tolist()]

    def align(self, texts: list[str | None]):
        """Per text n_a, n_b, n_groups and the digest; then text numbers and id pairs of all links."""
        if len(self.index) > MAX_UNITS or self.pairs.size > MAX_UNIT_TOKENS:
            self._forget()
        units = [self.units(t) if t else [] for t in texts]
        flat, sizes = list(chain.from_iterable(units)), _lengths(units)
        found = list(map(self.index.get, flat))
        if None in found:
            self.learn(list(dict.fromkeys(u for u, i in zip(flat, found, strict=True) if i is None)))
            found = list(map(self.index.get, flat))
        ids = np.array(found, np.int64)
        bad = _sums((self.n_a.all[ids] < 0).astype(np.int64), sizes) > 0
        digests, at = [], 0
        for size, wrong in zip(sizes.tolist(), bad.tolist(), strict=True):
            joined = "" if wrong else "".join(map(self.text.__getitem__, found[at : at + size]))[:-1]
            digests.append(hashlib.sha256(joined.encode()).hexdigest() if joined else "")
            at += size
        ids, sizes = ids[~np.repeat(bad, sizes)], np.where(bad, 0, sizes)
        n_a, n_b, n_groups = (_sums(column.all[ids], sizes) for column in (self.n_a, self.n_b, self.n_groups))
        links = self.n_a.all[ids] + self.n_b.all[ids] - self.n_groups.all[ids]
        places = np.repeat(self.start.all[ids] - (np.cumsum(links) - links), links) + np.arange(int(links.sum()))
        row = np.repeat(np.arange(len(units)), n_a + n_b - n_groups)
        return n_a, n_b, n_groups, digests, row, self.pairs.all[places]


def _flat(ids: list[list[int]]) -> np.ndarray:
    return np.fromiter(chain.from_iterable(ids), np.int64, sum(map(len, ids)))


def _lengths(lists: list[list]) -> np.ndarray:
    return np.fromiter(map(len, lists), np.int64, len(lists))


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of values that lie one after the other in groups of these sizes."""
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


@lru_cache(maxsize=1)
def aligner(a_path: str, b_path: str) -> Aligner:
    return Aligner(a_path, b_path)


def _binary(data: bytes, ends: np.ndarray) -> pa.Array:
    """Binary values that lie one after the other in ``data``."""
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def bitmaps(key: np.ndarray, times: np.ndarray, n_docs: int):
    """(pair, n, docs, planes) of the postings of a chunk; ``key`` is pair * 2^16 + document.

    ``docs`` holds the documents' 16-bit numbers, or one bit a document of the chunk where that is shorter. ``planes`` is
    empty where no document has the pair twice; else the first plane has the lowest digit of each document's number.
    """
    order = np.argsort(key)
    key, times = key[order], times[order]
    pair, doc = key >> 16, (key & 0xFFFF).astype("<u2")
    start = np.flatnonzero(np.diff(pair, prepend=-1))
    n = np.diff(start, append=len(pair))
    which = np.repeat(np.arange(len(n)), n)
    width = (n_docs + 7) // 8
    dense = 2 * n > width
    # Documents: numbers first, and bits written over a table of as many bytes as both kinds need.
    size = np.where(dense, width, 2 * n)
    end = np.cumsum(size)
    docs = np.zeros(int(size.sum()), np.uint8)
    rank = np.arange(len(pair)) - start[which]
    few = ~dense[which]
    at = (end - size)[which[few]] + 2 * rank[few]
    docs[at], docs[at + 1] = doc[few] & 0xFF, doc[few] >> 8
    for i in np.flatnonzero(dense):
        bits = np.zeros(8 * width, bool)
        bits[doc[start[i] : start[i] + n[i]]] = True
        docs[end[i] - width : end[i]] = np.packbits(bits, bitorder="little")
    # Planes: one bit a document of the bitmap.
    most = np.maximum.reduceat(times, start)
    count = np.where(most > 1, np.frexp(most.astype(np.float64))[1], 0)
    row = (n + 7) // 8
    plane_end = np.cumsum(count * row)
    planes = np.zeros(int((count * row).sum()), np.uint8)
    plane_start = plane_end - count * row
    for k in range(int(count.max(initial=0))):
        held = np.flatnonzero((count[which] > k) & ((times >> k) & 1 > 0))
        byte = plane_start[which[held]] + k * row[which[held]] + (rank[held] >> 3)
        np.bitwise_or.at(planes, byte, (1 << (rank[held] & 7)).astype(np.uint8))
    return pair[start], n, _binary(docs.tobytes(), end), _binary(planes.tobytes(), plane_end)


def postings(n: np.ndarray, docs: pa.Array, planes: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, document and number of links of every posting of bitmaps: the way back from ``bitmaps``."""
    size = np.diff(_offsets(docs))
    raw, at = _raw(docs), _offsets(docs)[:-1]
    which = np.repeat(np.arange(len(n)), n)
    rank = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
    doc = np.empty(len(which), np.int64)
    few = (size == 2 * n)[which]
    byte = at[which[few]] + 2 * rank[few]
    doc[few] = raw[byte].astype(np.int64) | raw[byte + 1].astype(np.int64) << 8
    ends = np.cumsum(n)
    for i in np.flatnonzero(size != 2 * n):
        bits = np.unpackbits(raw[at[i] : at[i] + size[i]], bitorder="little")
        doc[ends[i] - n[i] : ends[i]] = np.flatnonzero(bits)
    raw, at = _raw(planes), _offsets(planes)[:-1]
    row = (n + 7) // 8
    count = np.diff(_offsets(planes)) // np.maximum(row, 1)
    times = np.where(count[which] == 0, 1, 0)
    for k in range(int(count.max(initial=0))):
        held = np.flatnonzero(count[which] > k)
        byte = at[which[held]] + k * row[which[held]] + (rank[held] >> 3)
        times[held] += ((raw[byte] >> (rank[held] & 7)) & 1).astype(np.int64) << k
    return which, doc, times


def _offsets(values: pa.Array) -> np.ndarray:
    return np.frombuffer(values.buffers()[1], np.int32)[values.offset : values.offset + len(values) + 1].astype(np.int64)


def _raw(values: pa.Array) -> np.ndarray:
    data = values.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)


def _encoder(a_path: str, b_path: str, kept: list[pa.Field], chunk_docs: int, chunk_postings: int):
    schema = pa.schema(_ROW_TYPES + kept)

    def rows(size: int, /, **columns) -> pa.RecordBatch:
        def column(f: pa.Field) -> pa.Array:
            value = columns.get(f.name)
            return pa.nulls(size, f.type) if value is None else value if isinstance(value, pa.Array) else pa.array(value, f.type)

        return pa.RecordBatch.from_arrays([column(f) for f in schema], schema=schema)

    def run(batches):
        both = aligner(a_path, b_path)
        chunk, n_docs = TaskContext.get().partitionId() << 32, 0
        keys: list[np.ndarray] = []
        times: list[np.ndarray] = []

        def closed():
            if keys:
                pair, n, docs, planes = bitmaps(np.concatenate(keys), np.concatenate(times), n_docs)
                step = 1 << 16
                for a in range(0, len(pair), step):
                    part = slice(a, a + step)
                    k = len(pair[part])
                    yield rows(
                        k, posting=np.ones(k, bool), chunk=np.full(k, chunk), pair=pair[part], n=n[part],
                        docs=docs[part], planes=planes[part],
                    )

        for batch in batches:
            if n_docs + len(batch) > chunk_docs or sum(map(len, keys)) > chunk_postings:
                yield from closed()
                chunk, n_docs, keys, times = chunk + 1, 0, [], []
            for a in range(0, len(batch), chunk_docs):  # a batch has far fewer rows, except in tests
                if a:
                    yield from closed()
                    chunk, n_docs, keys, times = chunk + 1, 0, [], []
                part = batch.slice(a, chunk_docs)
                n_a, n_b, n_groups, digests, row, pair = both.align(part.column(0).to_pylist())
                key, n = np.unique((pair << 16) | (row + n_docs), return_counts=True)
                if len(key):
                    keys.append(key)
                    times.append(n)
                k = len(part)
                yield rows(
                    k, posting=np.zeros(k, bool), chunk=np.full(k, chunk), doc=np.arange(n_docs, n_docs + k), n_a=n_a, n_b=n_b,
                    n_groups=n_groups, n_links=n_a + n_b - n_groups, groups_sha256=digests,
                    **{f.name: part.column(i + 1) for i, f in enumerate(kept)},
                )
                n_docs += k
        yield from closed()

    return run


def _added_up(batches):
    """Sums of each document over the postings of its chunk; rows come sorted by chunk."""
    chunk, best, total = None, None, None

    def done() -> pa.RecordBatch:
        doc = np.flatnonzero(total)
        return pa.RecordBatch.from_pydict(
            {"chunk": np.full(len(doc), chunk), "doc": doc.astype(np.int32), "n_best": best[doc], "count_sum": total[doc]}
        )

    for batch in batches:
        chunks = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(chunks)) + 1).tolist(), len(chunks)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a == b:
                continue
            if chunks[a] != chunk:
                if chunk is not None:
                    yield done()
                chunk, best, total = chunks[a], np.zeros(CHUNK_DOCS, np.int64), np.zeros(CHUNK_DOCS, np.int64)
            part = batch.slice(a, b - a)
            n, count, top = (part.column(i).to_numpy(zero_copy_only=False) for i in (1, 4, 5))
            which, doc, times = postings(n, part.column(2), part.column(3))
            np.add.at(total, doc, times * count[which])
            np.add.at(best, doc, times * top[which])
    if chunk is not None:
        yield done()


def align(
    docs: DataFrame, a_path: str, b_path: str, keep: tuple[str, ...] = ("doc_id",), chunk_docs: int = CHUNK_DOCS,
    chunk_postings: int = CHUNK_POSTINGS,
) -> tuple[DataFrame, DataFrame, int]:
    """Encode once: (documents with their counts, bitmaps of pairs, number of pair numbers an A id has)."""
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = docs.sparkSession
    taken = docs.select(F.col("text").cast("string").alias("__text"), *(F.col(c).alias(f"__{c}") for c in keep))
    kept = list(to_arrow_schema(taken.schema))[1:]
    types = [_ROWS, *(f"`__{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)]
    encoded = taken.mapInArrow(_encoder(a_path, b_path, kept, min(chunk_docs, CHUNK_DOCS), chunk_postings), ", ".join(types))
    folder = new_folder(spark, "alignment")
    encoded.write.partitionBy("posting").parquet(folder)
    rows = spark.read.schema(encoded.schema).parquet(folder)
    own = ("chunk", "doc", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    aligned = rows.filter("NOT posting").select(*own, *(f"__{c}" for c in keep))
    return aligned, rows.filter("posting").select("chunk", "pair", "n", "docs", "planes"), _pairs_an_a(b_path)


def _pairs_an_a(b_path: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=b_path).vocab_size()


def scores(bitmaps: DataFrame, pairs_an_a: int) -> DataFrame:
    """(pair, a, b, count, best) of every linked id pair: in how many documents, and whether no pair of its A id has more."""
    counts = bitmaps.groupBy("pair").agg(F.sum("n").alias("count"))
    a = F.floor(F.col("pair") / F.lit(pairs_an_a)).cast("long")
    counts = counts.withColumn("a", a).withColumn("b", F.col("pair") - F.col("a") * pairs_an_a)
    # At most as many rows a window as B has ids.
    best = F.col("count") == F.max("count").over(Window.partitionBy("a"))
    return counts.select("pair", "a", "b", "count", best.cast("long").alias("best"))


def scored(docs: DataFrame, a_path: str, b_path: str, keep: tuple[str, ...] = ("doc_id",), **bounds) -> DataFrame:
    """One row per document: the columns to keep, counts, sums of its links' scores and the digest of its groups."""
    aligned, bits, pairs_an_a = align(docs, a_path, b_path, keep, **bounds)
    table = write_and_read(scores(bits, pairs_an_a).select("pair", "count", "best"), "alignment-scores")
    # Merged at any size, as scores grow with the corpus.
    sent = bits.join(table.hint("merge"), "pair").select("chunk", "n", "docs", "planes", "count", "best")
    sums = sent.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(_added_up, "chunk long, doc int, n_best long, count_sum long")
    return aligned.join(sums, ["chunk", "doc"], "left").select(
        *(F.col(f"__{c}").alias(c) for c in keep),
        *("n_a", "n_b", "n_groups", "n_links"),
        F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"),
        "groups_sha256",
    )


def default_tokenizers() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@register("op13_pair_bitmap_alignment")
def op13_pair_bitmap_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(documents(spark, sf_dir), *default_tokenizers())

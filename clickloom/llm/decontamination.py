"""Benchmark decontamination: one Aho-Corasick automaton over the word windows of all benchmark items.

Words are runs of digits, a-z and characters beyond ASCII, after A-Z is lower-cased. A window is ``WINDOW`` consecutive
words of an item; an item of fewer words, but not none, is one window. Words of the benchmark are numbered, windows are
entered as sequences of these numbers, and the words of a text stream through the automaton once; runs of words that the
benchmark does not have are passed over. Hit words are mapped back to offsets of the original text.

Bounds. Items are cut into slices that overlap by a window less one word, so no window is lost, and equal slices of one
item are taken once. Slices are dealt by hash to parts of at most ``PART_BYTES`` (measured, parts are doubled until all
fit, unless one single slice is larger). A part is what the driver holds and what a task gets; a benchmark of several
parts is scanned part by part, and what is found is written between. Documents are never shuffled.

Edge cases: null, empty and wordless texts have no words and no hits; empty, null and wordless items have no window; an
item without ``item_id`` marks words but is not listed; rows of one ``item_id`` are one item; an item listed once in a
document however often it occurs; very long texts are streamed with their words in memory; repeated documents get equal
answers; no ties arise, since every window counts; empty tables give empty results or no hits; only ``doc_id`` (or the
columns asked for) and ``text`` are read, so other columns may have any name.
"""

from __future__ import annotations

import pickle
import re
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickloom.llm.common import documents, read, register, write_and_read
from clickloom.llm.licenses import words

WINDOW = 10
SLICE_WORDS = 1_000
PART_BYTES = 2 << 20  # words of a part; its automaton takes about a hundred times as much

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_FOUND = "struct<n_words: long, hits: array<struct<first: long, last: long>>, items: array<string>>"
_FOUND_TYPE = pa.struct(
    [("n_words", pa.int64()), ("hits", pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))), ("items", pa.list_(pa.string()))]
)


def _cut(found: list[bytes], window: int, slice_words: int) -> list[list[bytes]]:
    """Slices that together hold every window of a word list."""
    step = max(1, slice_words - window + 1)
    return [found[a : a + step + window - 1] for a in range(0, max(1, len(found) - window + 1), step)]


def slices(benchmark: DataFrame, window: int = WINDOW, slice_words: int = SLICE_WORDS) -> DataFrame:
    """(item, words) of every slice: the words lower-cased and joined by a space."""

    def run(batches):
        for batch in batches:
            items, made = [], []
            for item, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for part in _cut(words(text), window, slice_words):
                    if part:
                        items.append(item)
                        made.append(b" ".join(part).decode())
            yield pa.RecordBatch.from_pydict({"item": pa.array(items, pa.string()), "words": pa.array(made, pa.string())})

    named = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text"))
    return named.mapInArrow(run, "item string, words string").distinct()


def parts(benchmark: DataFrame, window: int = WINDOW, part_bytes: int = PART_BYTES, slice_words: int = SLICE_WORDS):
    """Yield the benchmark in parts of bounded size, each as the bytes that a task gets."""
    cut = write_and_read(slices(benchmark, window, slice_words), "benchmark-slices")
    size = F.octet_length("words") + F.coalesce(F.octet_length("item"), F.lit(0))
    total, widest = cut.agg(F.coalesce(F.sum(size), F.lit(0)), F.coalesce(F.max(size), F.lit(0))).first()
    n = max(1, -(-total // part_bytes))
    part = lambda n: F.pmod(F.xxhash64("words"), F.lit(n)).alias("part")
    while n > 1 and cut.groupBy(part(n)).agg(F.sum(size).alias("size")).agg(F.max("size")).first()[0] > max(part_bytes, widest):
        n *= 2
    for i in range(n):
        rows = cut.filter(part(n) == i).collect()  # at most part_bytes, as measured
        if rows:
            yield pickle.dumps(sorted(((r["words"].encode(), r["item"]) for r in rows), key=lambda x: (x[0], x[1] or "")))


class Windows:
    """The automaton of one part: windows as sequences of word numbers, and the items of each window."""

    def __init__(self, rows: list[tuple[bytes, str | None]], window: int):
        import ahocorasick

        self.vocabulary: dict[bytes, int] = {}
        self.sizes: list[int] = []
        self.items: list[set[str]] = []
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        number: dict[tuple[int, ...], int] = {}
        for text, item in rows:
            ids = tuple(self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in text.split(b" "))
            for at in range(max(1, len(ids) - window + 1)):
                key = ids[at : at + window]
                n = number.setdefault(key, len(number))
                if n == len(self.items):
                    self.sizes.append(len(key))
                    self.items.append(set())
                    self.automaton.add_word(key, n)
                if item is not None:
                    self.items[n].add(item)
        self.shortest = min(self.sizes, default=0)
        self.automaton.make_automaton()

    def scan(self, found: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Runs of hit words (first, last) and the items whose windows occur."""
        ids = np.fromiter(map(self.vocabulary.get, found, repeat(0)), np.int32, len(found))
        edges = np.flatnonzero(np.diff(np.concatenate([[0], (ids > 0).view(np.int8), [0]])))
        hits, seen = [], set()
        for start, end in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if end - start >= self.shortest:
                for at, n in self.automaton.iter(tuple(ids[start:end].tolist())):
                    hits.append((start + at + 1 - self.sizes[n], start + at))
                    seen.add(n)
        return merged(hits), set().union(*(self.items[n] for n in seen))


def merged(hits: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs that cover the same words as the given ones, in order, none touching the next."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(hits):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(last, out[-1][1]))
        else:
            out.append((first, last))
    return out


@lru_cache(maxsize=1)
def _windows(part: bytes, window: int) -> Windows:
    return Windows(pickle.loads(part), window)


def _scanned(text: Column, before: Column, part: bytes, window: int) -> Column:
    @F.arrow_udf(_FOUND)
    def scan(texts: pa.Array, earlier: pa.Array) -> pa.Array:
        windows, rows = _windows(part, window), []
        for text, old in zip(texts, earlier, strict=True):
            found, old = words(text.as_py()), old.as_py()
            hits, items = windows.scan(found)
            if old is not None:
                hits = merged(hits + [(h["first"], h["last"]) for h in old["hits"]])
                items = items.union(old["items"])
            rows.append({"n_words": len(found), "hits": [{"first": a, "last": b} for a, b in hits], "items": sorted(items)})
        return pa.array(rows, _FOUND_TYPE)

    return scan(text, before)


def find(
    docs: DataFrame, benchmark: DataFrame, keep: tuple[str, ...] = ("doc_id",), window: int = WINDOW,
    part_bytes: int = PART_BYTES, slice_words: int = SLICE_WORDS,
) -> DataFrame:
    """The columns to keep, ``text`` and ``found``: number of words, runs of hit words, ids of the occurring items."""
    kept = [c for c in keep if c != "text"]
    rows = docs.select(*kept, "text", F.lit(None).cast(_FOUND).alias("__found"))
    first = True
    for part in parts(benchmark, window, part_bytes, slice_words):
        rows = rows if first else write_and_read(rows, "decontamination")
        rows = rows.withColumn("__found", _scanned(F.col("text"), F.col("__found"), part, window))
        first = False
    if first:  # a benchmark without any word
        rows = rows.withColumn("__found", _scanned(F.col("text"), F.col("__found"), pickle.dumps([]), window))
    return rows.withColumnRenamed("__found", "found")


def spans(found: DataFrame) -> DataFrame:
    """``found`` with ``spans``: start and end offsets (in code points) of the hit runs in the original text."""

    @F.arrow_udf("array<struct<start: long, end: long>>")
    def offsets(texts: pa.Array, hits: pa.Array) -> pa.Array:
        out = []
        for text, runs in zip(texts, hits.to_pylist(), strict=True):
            if runs:
                at = [m.span() for m in _WORD.finditer(lowered(text.as_py()))]
                runs = [{"start": at[r["first"]][0], "end": at[r["last"]][1]} for r in runs]
            out.append(runs)
        return pa.array(out, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))

    return found.withColumn("spans", offsets(F.col("text"), F.col("found.hits")))


def lowered(text: str) -> str:
    """A-Z lower-cased and nothing else; every character keeps its place."""
    return text.encode().lower().decode()


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, in which no window of the benchmark occurs."""
    return find(docs, benchmark, tuple(docs.columns)).filter(F.size("found.hits") == 0).select(*docs.columns)


def digests(found: DataFrame) -> DataFrame:
    """One row per document: counts, digest of the item ids and the verdict."""
    n_hit = F.aggregate("found.hits", F.lit(0).cast("long"), lambda n, h: n + h["last"] - h["first"] + 1)
    return found.select(
        "doc_id",
        "found.n_words",
        n_hit.alias("n_hit"),
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("found.items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


# Windows of documents are joined with windows of items as text; short items are joined at their own lengths.
ORACLE = r"""
WITH lower_items AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark WHERE text IS NOT NULL
), item_windows AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS n, array_to_string(ws[i : i + least(len(ws), 10) - 1], ' ') AS k
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM lower_items WHERE len(ws) > 0)
), docs AS (
  SELECT row_number() OVER () AS r, doc_id,
    coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS ws
  FROM documents
), doc_windows AS (
  SELECT r, n, i, array_to_string(ws[i : i + n - 1], ' ') AS k
  FROM (SELECT r, n, ws, unnest(range(1, len(ws) - n + 2)) AS i
        FROM docs, (SELECT DISTINCT n FROM item_windows) WHERE len(ws) >= n)
), found AS (
  SELECT r, i, n, item_id FROM doc_windows JOIN item_windows USING (n, k)
), hit AS (
  SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT DISTINCT r, unnest(range(i, i + n)) AS j FROM (SELECT DISTINCT r, i, n FROM found)) GROUP BY r
), items AS (
  SELECT r, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS names
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS s FROM found WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (r) LEFT JOIN items USING (r)
"""


@register("op11_aho_corasick_decontamination", ORACLE)
def op11_aho_corasick_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(find(documents(spark, sf_dir), read(spark, sf_dir, "benchmark")))

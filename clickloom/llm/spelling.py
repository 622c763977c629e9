"""Grouping of spelling variants: words at edit distance one, joined by asymmetric q-chunks.

Words are runs of A-Z, a-z and U+00C0 to U+00FF with A-Z lower-cased, of at least ``MIN_CHARS`` code points and
``MIN_COUNT`` occurrences. Of two words at distance one, the longer (or either, if equally long) gives two disjoint
chunks, its halves; the other gives its positional grams. One edit spares one of the two chunks, so the other word has it
as a gram of the same length that starts at the same place or one before. Which of these it must be follows from the
two lengths, so a word sends, of all its grams, the four that can meet a chunk. Chunks and grams meet in a join on
(lengths, place, characters) and every pair that meets is verified.

A chunk that many words share would make all pairs of them. A key whose pairs would be more than ``PAIRS_A_ROW`` times
its rows is not joined: what lies beyond the shared chunk is at distance one, too, so it is halved again, and rows
go on with the longer key. That ends at the latest where one character is left, and there every pair is a result. So the
pairs that are verified grow with the number of words and of results, whatever prefixes or endings words share.

A word's form is the near word of largest count (ties: the smallest in code-point order) if that is at least
``RATIO`` times the word's own; its root is the end of the chain of forms. Counts grow along a chain, so it ends, and
chains are resolved by doubling over the words that are forms themselves.

Edge cases: null and empty texts have no words; a null id counts as an empty string where ids choose the letter that is
dropped; very long texts and words are whole words like others; repeated rows count again; an empty table gives an empty
result; only ``doc_id`` and ``text`` are read, so other columns may have any name.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickloom.llm.common import documents, register, write_and_read

MIN_CHARS, MIN_COUNT, RATIO = 6, 5, 5
DROP_EVERY = 199  # one (document, word) in so many loses a letter
PAIRS_A_ROW = 32
SALTS = 16
FLUSH_CHARS = 16 << 20  # characters of the distinct words a task gathers before it sends them

# Characters of a word are kept, A-Z lower-cased; every other one parts words. One byte a code point.
_LETTERS = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0xC0 else 0x20 for c in range(256)
)
_SENT = pa.schema([("word", pa.string()), ("n", pa.int64())])


def runs(text: str | None) -> list[bytes]:
    """Words of a text in Latin-1; characters beyond U+00FF part words."""
    return text.encode("latin-1", "replace").translate(_LETTERS).split() if text else []


def dropped(doc: bytes, run: bytes, every: int = DROP_EVERY) -> bytes:
    """The run without one letter if its checksum says so. ``doc`` is the checksum of the id and the colon."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), doc)
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _sender(min_chars: int, every: int):
    def run(batches):
        found: dict[bytes, int] = defaultdict(int)
        held = 0

        def sent():
            words = [w.decode("latin-1") for w in found]
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(list(found.values()), pa.int64())], schema=_SENT)

        for batch in batches:
            for doc, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                start = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for word, n in Counter(runs(text)).items():
                    if len(word) >= min_chars:
                        word = dropped(start, word, every)
                        if len(word) >= min_chars:
                            if word not in found:
                                held += len(word) + 50
                            found[word] += n
                if held > FLUSH_CHARS:
                    yield sent()
                    found.clear()
                    held = 0
        if found:
            yield sent()

    return run


def vocabulary(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, every: int = DROP_EVERY) -> DataFrame:
    """(word, n) of the words of all documents that occur often enough."""
    sent = docs.select("doc_id", F.col("text").cast("string")).mapInArrow(_sender(min_chars, every), "word string, n long")
    return sent.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def _piece(word: Column, first: Column, length: Column) -> Column:
    return F.substring(word, first + 1, length)


def _halved(rows: DataFrame) -> DataFrame:
    """Rows go on with each half of what is left of the chunk side: once as the chunk that the edit spares.

    A row: ``key`` (what pairs share so far), ``chunk`` (whether the word gives chunks or grams), ``size`` (what is left on
    the chunk side), ``first`` and ``left`` (the part of the word that is not shared yet).
    """
    size, left, first = F.col("size"), F.col("left"), F.col("first")
    half = F.floor(size / 2).cast("int")
    # The first half is spared: it starts where the rest starts. The second: it ends where the rest ends.
    spared = [
        (F.lit(0), half, first, size - half, first + half, left - half),
        (F.lit(1), size - half, first + left - (size - half), half, first, left - (size - half)),
    ]
    made = [
        F.struct(
            F.xxhash64("key", size, side, _piece(F.col("word"), at, length)).alias("key"),
            rest.alias("size"),
            start.alias("first"),
            remains.alias("left"),
        )
        for side, length, at, rest, start, remains in spared
    ]
    return rows.select("word", "n", "chunk", F.explode(F.array(*made)).alias("at")).select("word", "n", "chunk", "at.*")


def _starts(words: DataFrame) -> DataFrame:
    """Every word as the chunk side of its length, and as the gram side of its own length and the next."""
    size = F.char_length("word")
    roles = F.array(
        *(F.struct(F.lit(c).alias("chunk"), (size + d).alias("size")) for c, d in ((True, 0), (False, 0), (False, 1)))
    )
    rows = words.select("word", "n", F.explode(roles).alias("role"), size.alias("left"))
    return rows.select("word", "n", F.xxhash64(F.lit(0)).alias("key"), "role.chunk", "role.size", F.lit(0).alias("first"), "left")


def _met(rows: DataFrame) -> DataFrame:
    """Verified pairs (a, a_n, b, b_n) of rows that share a key."""
    chunks = rows.filter("chunk").select("key", F.col("word").alias("a"), F.col("n").alias("a_n"))
    grams = rows.filter("NOT chunk").select("key", F.col("word").alias("b"), F.col("n").alias("b_n"))
    longer = F.char_length("a") > F.char_length("b")
    return (
        chunks.join(grams, "key")
        .filter((longer | (F.col("a") < F.col("b"))) & (F.levenshtein("a", "b", 1) == 1))
        .select("a", "a_n", "b", "b_n")
    )


def near_pairs(words: DataFrame, pairs_a_row: int = PAIRS_A_ROW) -> DataFrame:
    """Every pair (a, a_n, b, b_n) of words at distance one, once; ``words`` has word (distinct) and n."""
    rows = _halved(_starts(words))
    found = []
    while True:
        rows = write_and_read(rows, "spelling-keys")
        sizes = rows.groupBy("key").agg(
            F.count_if("chunk").alias("chunks"), F.count_if(~F.col("chunk")).alias("grams"), F.max("size").alias("size")
        )
        many = F.col("chunks") * F.col("grams") > pairs_a_row * (F.col("chunks") + F.col("grams"))
        hot = write_and_read(sizes.filter(many & (F.col("size") > 1)).select("key"), "spelling-hot")
        if hot.isEmpty():
            found.append(write_and_read(_met(rows), "spelling-pairs"))
            break
        # Salted, because a hot key may hold any share of the rows.
        salted = hot.select("key", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"), F.lit(True).alias("hot"))
        told = rows.withColumn("salt", F.pmod(F.hash("word"), F.lit(SALTS))).join(salted, ["key", "salt"], "left")
        told = write_and_read(told.drop("salt"), "spelling-told")
        found.append(write_and_read(_met(told.filter("hot IS NULL")), "spelling-pairs"))
        rows = _halved(told.filter("hot").drop("hot"))
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    # A pair can meet at both chunks, where letters repeat.
    return pairs.distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(form, root) of the words that are a form; ``forms`` has word and form of the words that have one."""
    used = forms.select(F.col("form").alias("word")).distinct()
    to = used.join(forms.select("word", F.col("form").alias("root")), "word", "left")
    to = to.select("word", F.coalesce("root", "word").alias("root"))
    while True:
        to = write_and_read(to, "spelling-roots")
        on = to.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = on.filter("root <> next")
        moved = to.join(further, "root", "left")
        if moved.filter("next IS NOT NULL").isEmpty():
            return to.select(F.col("word").alias("form"), "root")
        to = moved.select("word", F.coalesce("next", "root").alias("root"))


def grouped(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of a table (word, n)."""
    words = write_and_read(words, "spelling-words")
    pairs = write_and_read(near_pairs(words), "spelling-near")
    both = pairs.select(F.col("a").alias("word"), "a_n", F.col("b").alias("other"), F.col("b_n").alias("other_n")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("b_n").alias("a_n"), F.col("a").alias("other"), F.col("a_n").alias("other_n"))
    )
    best = both.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"), F.first("a_n").alias("n")
    )
    enough = -F.col("best.less") >= ratio * F.col("n")
    near = write_and_read(
        best.select(
            "word",
            "n_near",
            F.when(enough, F.col("best.other")).alias("form"),
            F.when(enough, -F.col("best.less")).alias("form_n"),
        ),
        "spelling-forms",
    )
    roots = _roots(near.filter("form IS NOT NULL").select("word", "form"))
    return (
        words.join(near, "word", "left")
        .join(roots, "form", "left")
        .select(
            "word",
            "form",
            F.coalesce("root", "word").alias("root"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            "form_n",
        )
    )


# Independent of chunks: words are near if one's deletion variant is the other, or both have one variant at one place.
ORACLE = r"""
WITH RECURSIVE poly AS (
  SELECT list(list_reduce([CAST(i AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0],
      lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, CAST(3988292384 AS BIGINT)) ELSE c >> 1 END) ORDER BY i) AS t
  FROM (SELECT unnest(range(256)) AS i)
), found AS (
  SELECT doc_id, w, count(*) AS c
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                 '[A-Za-z\x{C0}-\x{FF}]{6,}')) AS w FROM documents)
  GROUP BY doc_id, w
), hexed AS (
  SELECT w, c, hex(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w) AS x FROM found
), summed AS (
  SELECT w, c, xor(CAST(4294967295 AS BIGINT), list_reduce(
      list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(len(x) // 2), lambda i:
          CAST(16 * (strpos('0123456789ABCDEF', x[2 * i + 1]) - 1) + strpos('0123456789ABCDEF', x[2 * i + 2]) - 1 AS BIGINT))),
      lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]))) AS h
  FROM hexed, poly
), words AS (
  SELECT word, CAST(sum(c) AS BIGINT) AS n
  FROM (SELECT CASE WHEN h % 199 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, c FROM summed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5
), cuts AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS v
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), pairs AS (
  SELECT a.word AS a, a.n AS an, b.word AS b, b.n AS bn FROM cuts a JOIN words b ON a.v = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM cuts a JOIN words b ON a.v = b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM cuts a JOIN cuts b ON a.v = b.v AND a.i = b.i AND a.word <> b.word
), best AS (
  SELECT a AS word, count(*) AS n_near,
    arg_min(b, (-bn, b)) AS top, max(bn) AS top_n, any_value(an) AS n
  FROM pairs GROUP BY a
), forms AS (
  SELECT word, top AS form, top_n AS form_n FROM best WHERE top_n >= 5 * n
), chain(word, top) AS (
  SELECT word, form FROM forms
  UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON c.top = f.word
), roots AS (
  SELECT word, top AS root FROM chain WHERE top NOT IN (SELECT word FROM forms)
)
SELECT word, form, coalesce(root, word) AS root, words.n AS n, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near, form_n
FROM words LEFT JOIN best USING (word) LEFT JOIN forms USING (word) LEFT JOIN roots USING (word)
"""


@register("op12_q_chunk_spellings", ORACLE)
def op12_q_chunk_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouped(vocabulary(documents(spark, sf_dir)))

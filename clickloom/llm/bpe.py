"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

The rank file's path must be readable on every executor. Each Python worker builds the encoder once.

Long texts are cut before encoding where the pattern is sure to end a match: before white space that follows a
visible character, or where a run of ASCII letters or of digits ends. A run of white space too long for the
library's pattern engine is encoded as the match or matches that the pattern would make of it. So the ids are
those of the whole text. Decoding joins the bytes of the ids and does not need them to be valid UTF-8 inside.

Edge cases: null counts as empty, an empty text has no ids; repeated rows are encoded each; an empty table gives
an empty result; other columns are kept and may have any name but that of the new column.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickloom.llm.common import documents, register

PIECE_CHARS = 50_000
_BOUNDARY = regex.compile(r"(?<=[!-~\p{L}\p{N}])(?=[ \t\n\r])|(?<=[A-Za-z])(?=[!-@\[-`{-~])|(?<=[0-9])(?=[!-/:-~])")
_LONG_SPACE = regex.compile(r"\s{50000,}")


@lru_cache(maxsize=4)
def _encoding(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, chars: int = PIECE_CHARS) -> Iterator[str]:
    """Cut a text at safe boundaries into pieces of about ``chars`` characters."""
    at = 0
    while len(text) - at > chars:
        found = _BOUNDARY.search(text, at + chars)
        if found is None:
            break
        yield text[at : found.start()]
        at = found.start()
    yield text[at:]


def _plain(encoding, text: str) -> list[int]:
    """Ids of one piece. In a long run of white space the last character belongs to what follows."""
    ids, at = [], 0
    for run in _LONG_SPACE.finditer(text) if len(text) >= 50_000 else ():
        end = run.end() if run.end() == len(text) else run.end() - 1
        ids += encoding.encode_ordinary(text[at : run.start()])
        ids += encoding._encode_single_piece(text[run.start() : end])
        at = end
    return ids + encoding.encode_ordinary(text[at:])


def encode_text(text: str | None, path: str, pattern: str) -> list[int]:
    encoding = _encoding(path, pattern)
    if not text:
        return []
    if len(text) <= PIECE_CHARS:
        return encoding.encode_ordinary(text)
    # A long run of white space at the end of a piece has to see what follows it, so it is never cut there.
    return [i for piece in pieces(text) for i in _plain(encoding, piece)]


def _column(ids: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.empty(0, np.int32), *ids])))


def encoded(text: Column, path: str, pattern: str) -> Column:
    """Ids of a text as an array of int."""

    @F.arrow_udf("array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        return _column([np.asarray(encode_text(t.as_py(), path, pattern), np.int32) for t in texts])

    return encode(text)


def decoded(ids: Column, path: str, pattern: str) -> Column:
    """Raw bytes of an array of ids."""

    @F.arrow_udf("binary")
    def decode(rows: pa.Array) -> pa.Array:
        encoding = _encoding(path, pattern)
        return pa.array([encoding.decode_bytes(r.values.to_pylist()) if r.is_valid else None for r in rows], pa.binary())

    return decode(ids)


def round_trip(text: Column, path: str, pattern: str) -> Column:
    """Struct of ids and the bytes decoded from them, in one call: Spark would encode again for a chained decoding."""

    @F.arrow_udf("ids array<int>, decoded binary")
    def both(texts: pa.Array) -> pa.Array:
        ids, raw = [], []
        for text in texts:  # one list of Python numbers at a time: they take nine times the room of the array
            found = encode_text(text.as_py(), path, pattern)
            raw.append(_encoding(path, pattern).decode_bytes(found))
            ids.append(np.asarray(found, np.int32))
        return pa.StructArray.from_arrays([_column(ids), pa.array(raw, pa.binary())], ["ids", "decoded"])

    return both(text)


def encode(docs: DataFrame, path: str, pattern: str, out: str = "ids") -> DataFrame:
    return docs.withColumn(out, encoded(F.col("text"), path, pattern))


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    return df.withColumn(out, decoded(F.col(ids), path, pattern))


def digests(docs: DataFrame, path: str, pattern: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Encode, decode, and return per document the number of ids and both digests, after the columns to keep."""
    coded = docs.select(*keep, round_trip(F.col("text"), path, pattern).alias("__coded"))
    ids = F.col("__coded.ids")
    return coded.select(
        *keep,
        F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(F.array_join(ids.cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("__coded.decoded", 256).alias("decoded_sha256"),
    )


def default_tokenizer() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@register("op6_byte_bpe")
def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(documents(spark, sf_dir), *default_tokenizer())

"""Bitmaps of hash slots seen once and seen at least twice, built over a whole table.

Every row carries the hashes of one document, each at most once. A slot that two documents (or two hashes) touch is
set in the second bitmap, so a hash that two documents share is always found there; a hash found there is only a
suspect. The slot space is cut into segments. Tasks send the slots they touched, segment by segment, and segments are
merged as a stream: what is in memory is one segment and one row. The result is bounded by the number of slots.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SEGMENT = 2**16
MIN_SLOTS, MAX_SLOTS = 2**20, 2**31  # 128 KB and 256 MB of each bitmap
FLUSH = 2**20  # slots a task gathers before it sends them: a few MB

Batches = Iterator[pa.RecordBatch]
Arrays = Callable[[Batches], Iterator[np.ndarray]]


def slots_for(expected: int, per_hash: int) -> int:
    """Number of slots for so many hashes: a power of two."""
    return int(min(MAX_SLOTS, max(MIN_SLOTS, 1 << max(0, int(expected * per_hash - 1)).bit_length())))


def slots_of(hashes: np.ndarray, slots: int, k: int) -> np.ndarray:
    """``k`` slots of each hash, one row each: double hashing over the two halves of 64 bits."""
    h = hashes.view(np.uint64)
    step = (h >> np.uint64(33)) | np.uint64(1)
    with np.errstate(over="ignore"):
        return np.stack([((h ^ (h >> np.uint64(29))) + np.uint64(i) * step) & np.uint64(slots - 1) for i in range(k)])


def hash_arrays(batches: Batches) -> Iterator[np.ndarray]:
    """Hashes of an array<long> column, nulls left out, an array a batch."""
    for batch in batches:
        yield batch.column(0).flatten().drop_null().to_numpy(zero_copy_only=False)


def _touched(found: list[np.ndarray]) -> pa.RecordBatch:
    every = np.concatenate(found)
    every.sort()
    first = np.ones(len(every), bool)
    np.not_equal(every[1:], every[:-1], out=first[1:])
    at = np.flatnonzero(first).astype(np.int32)
    unique = every[at]
    again = np.diff(at, append=np.int32(len(every))) > 1
    places = (unique % np.uint32(SEGMENT)).astype(np.uint16)
    ids, start = np.unique(unique // np.uint32(SEGMENT), return_index=True)
    ends = np.append(start[1:], len(unique))
    return pa.RecordBatch.from_pydict(
        {
            "segment": ids.astype(np.int32),
            "once": [places[a:b].tobytes() for a, b in zip(start, ends, strict=True)],
            "twice": [places[a:b][again[a:b]].tobytes() for a, b in zip(start, ends, strict=True)],
        },
        schema=pa.schema([("segment", pa.int32()), ("once", pa.binary()), ("twice", pa.binary())]),
    )


def _sender(arrays: Arrays, slots: int, k: int):
    def run(batches: Batches) -> Batches:
        found, n = [], 0
        for values in arrays(batches):
            if len(values):
                found.append(slots_of(values, slots, k).astype(np.uint32).ravel())  # at most MAX_SLOTS
                n += len(found[-1])
            if n >= FLUSH:
                yield _touched(found)
                found, n = [], 0
        if found:
            yield _touched(found)

    return run


def _merger(times: int):
    """Merge rows that come sorted by segment into the bitmap of the slots seen ``times`` times."""

    def run(batches: Batches) -> Batches:
        current, once, twice = None, None, None

        def done() -> pa.RecordBatch:
            bits = np.packbits(once if times == 1 else twice, bitorder="little").tobytes()
            return pa.RecordBatch.from_pydict(
                {"segment": [current], "bits": [bits]}, schema=pa.schema([("segment", pa.int32()), ("bits", pa.binary())])
            )

        for batch in batches:
            for segment, a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if segment != current:
                    if current is not None:
                        yield done()
                    current, once, twice = segment, np.zeros(SEGMENT, bool), np.zeros(SEGMENT, bool)
                a, b = np.frombuffer(a, np.uint16), np.frombuffer(b, np.uint16)
                twice[b] = True
                twice[a[once[a]]] = True
                once[a] = True
        if current is not None:
            yield done()

    return run


def bitmap(df: DataFrame, slots: int, k: int, times: int = 2, arrays: Arrays = hash_arrays) -> bytes:
    """Bitmap of the slots seen at least ``times`` (1 or 2) times.

    ``arrays`` makes hash arrays of the batches of ``df``; by default its first column is array<long>.
    """
    sent = df.mapInArrow(_sender(arrays, slots, k), "segment int, once binary, twice binary")
    merged = sent.repartition("segment").sortWithinPartitions("segment").mapInArrow(_merger(times), "segment int, bits binary")
    bits = bytearray(slots // 8)
    for row in merged.toLocalIterator():
        at = row["segment"] * SEGMENT // 8
        bits[at : at + SEGMENT // 8] = row["bits"]
    return bytes(bits)


def suspects(hashes: np.ndarray, bitmap: np.ndarray, slots: int, k: int) -> np.ndarray:
    """Which hashes have all their slots in the bitmap (an array of bytes)."""
    hit = np.ones(len(hashes), bool)
    for row in slots_of(hashes, slots, k):
        hit &= (bitmap[(row >> np.uint64(3)).astype(np.int64)] >> (row & np.uint64(7)).astype(np.uint8)) & 1 > 0
    return hit

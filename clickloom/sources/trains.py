"""One pass over the records of train files: minute markers, clicks of whole minutes, and the rest.

A range of records knows the minutes that begin and end inside it. Their clicks leave the reader with train, time
and the interval to the previous click of the train, so they can be reduced where they are read. The records before
the first and after the last marker of a range belong to minutes that other ranges hold a part of; they leave as
they are ("loose") and meet later. There are two such minutes a range, whatever the size of the files.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from clickloom.layout import END_OF_FILE, LAST_FPOD_CLICK_TYPE, LAYOUTS, MARKER, TICK_US, TRAIN_DETAIL
from clickloom.sources.records import SPLIT_BYTES, Quarantine, failure, ranges, record_blocks, spread

# What a row is. The last row of a range has the number of its markers.
ENDED, MARK, CLICK, LOOSE_TRAIN, LOOSE_CLICK, RANGE = "end", "marker", "click", "loose train", "loose click", "range"
# Records of one minute that are held back; a longer minute leaves the reader as loose records.
MAX_HELD = 1 << 20

MARKER_BYTES = {"CP3": (4, 5, 9), "FP3": (4, 8, 9, 10)}
Items = dict[str, np.ndarray]


def _schema(kind: str, values: tuple[int, ...]) -> pa.Schema:
    longs = ("split", "markers")
    fields = [pa.field("pod_file", pa.string()), *[pa.field(c, pa.int64()) for c in longs], pa.field("what", pa.string())]
    fields += [pa.field("rec_no", pa.int64()), pa.field("train_id", pa.int32()), pa.field("class_byte", pa.int32())]
    fields += [pa.field(c, pa.int64()) for c in ("time_us", "ici_us", "place")]
    names = [f"b{i}" for i in MARKER_BYTES[kind]] + [f"v{i}" for i in values]
    return pa.schema([*fields, *[pa.field(n, pa.int32()) for n in names], pa.field("error", pa.string())])


class _Range:
    """Walk over one range of records."""

    def __init__(self, kind: str, values: tuple[int, ...], split: dict):
        self.kind, self.values, self.split = kind, values, split
        self.schema, self.layout = _schema(kind, values), LAYOUTS[kind]
        self.seen, self.loose, self.ended = 0, 0, False
        self.held: list[Items] = []

    def _batch(self, what: str, n: int, columns: Items, nulls: dict[str, np.ndarray] | None = None) -> pa.RecordBatch:
        nulls = nulls or {}
        out = []
        for field in self.schema:
            if field.name in ("pod_file", "split", "what"):
                same = {"pod_file": self.split["pod_file"], "split": self.split["no"], "what": what}
                out.append(pa.repeat(pa.scalar(same[field.name], field.type), n))
            elif field.name in columns:
                out.append(pa.array(columns[field.name], field.type, mask=nulls.get(field.name)))
            else:
                out.append(pa.nulls(n, field.type))
        return pa.RecordBatch.from_arrays(out, schema=self.schema)

    def _items(self, start: int, block: np.ndarray, kinds: np.ndarray, marked: np.ndarray) -> Items:
        if self.kind == "CP3":
            at = np.flatnonzero(kinds < MARKER)
            train, of_class, detail = kinds[at], block[at, 36], np.ones(len(at), bool)
        else:
            at = np.flatnonzero((kinds == TRAIN_DETAIL) | (kinds <= LAST_FPOD_CLICK_TYPE))
            train, of_class, detail = block[at, 15], block[at, 14], kinds[at] == TRAIN_DETAIL
        high, mid, low = (block[at, i].astype(np.int64) for i in range(3))
        found = {
            "markers": marked[at],
            "rec_no": start + at,
            "train_id": train.astype(np.int32),
            "class_byte": of_class.astype(np.int32),
            "time_us": ((high * 256 + mid) * 256 + low) * TICK_US,
            "detail": detail,
        }
        return found | {f"v{i}": block[at, i - 1].astype(np.int32) for i in self.values}

    def block(self, start: int, block: np.ndarray) -> Iterator[pa.RecordBatch]:
        kinds = block[:, self.layout.type_byte - 1]
        end = np.flatnonzero(kinds == END_OF_FILE) if self.kind == "CP3" else ()
        if len(end):  # a CP3 file ends before its first end-of-file record
            self.ended = True
            block, kinds = block[: end[0]], kinds[: end[0]]
        marked = self.seen + np.cumsum(kinds == MARKER, dtype=np.int64)
        at = np.flatnonzero(kinds == MARKER)
        if len(at):
            named = {f"b{i}": block[at, i - 1].astype(np.int32) for i in MARKER_BYTES[self.kind]}
            yield self._batch(MARK, len(at), {"markers": marked[at], "rec_no": start + at, **named})
        if len(marked):
            self.seen = int(marked[-1])
            yield from self._sorted_out(self._items(start, block, kinds, marked))
        if self.ended:
            yield self._batch(ENDED, 1, {"markers": np.array([self.seen]), "rec_no": np.array([start + int(end[0])])})

    def _sorted_out(self, new: Items) -> Iterator[pa.RecordBatch]:
        """Whole minutes go out as clicks, the first and an oversized minute as loose records; the last one is held."""
        self.held.append(new)
        if self.seen == self.loose:
            yield from self._as_loose(self.held.pop())
            return
        items = {c: np.concatenate([h[c] for h in self.held]) for c in new}
        of = items["markers"]
        loose, open_ = of == self.loose, of == self.seen
        if open_.sum() > MAX_HELD:
            loose, self.loose, open_ = loose | open_, self.seen, np.zeros(len(of), bool)
        yield from self._as_loose({c: v[loose] for c, v in items.items()})
        whole = ~loose & ~open_
        if whole.any():
            yield self._as_clicks({c: v[whole] for c, v in items.items()})
        self.held = [{c: v[open_] for c, v in items.items()}]

    def _as_loose(self, items: Items) -> Iterator[pa.RecordBatch]:
        for what, rows in ((LOOSE_TRAIN, items["detail"]), (LOOSE_CLICK, ~items["detail"])):
            n = int(rows.sum())
            if n:
                hidden = ("train_id", "class_byte") if what == LOOSE_CLICK else ("time_us",) if self.kind == "FP3" else ()
                yield self._batch(what, n, {c: v[rows] for c, v in items.items() if c not in hidden})

    def _as_clicks(self, items: Items) -> pa.RecordBatch:
        """Clicks of whole minutes with their place in the train and the interval to the one before."""
        known = np.ones(len(items["rec_no"]), bool)
        if self.kind == "FP3":
            items, known = self._paired(items)
        key = items["markers"] * 256 + items["train_id"]
        order = np.argsort(key, kind="stable")
        first = np.concatenate([[True], key[order][1:] != key[order][:-1]])
        start = np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
        before = np.concatenate([[0], order[:-1]])
        ici, place, no_ici = (np.empty(len(order), kind) for kind in (np.int64, np.int64, bool))
        place[order] = np.arange(len(order)) - start + 1
        ici[order] = items["time_us"][order] - items["time_us"][before]
        no_ici[order] = first | ~known[order] | ~known[before]
        return self._batch(CLICK, len(order), {**items, "ici_us": ici, "place": place}, {"time_us": ~known, "ici_us": no_ici})

    def _paired(self, items: Items) -> tuple[Items, np.ndarray]:
        """The i-th train record of a minute describes its i-th click record."""
        trains, clicks = ({c: v[rows] for c, v in items.items()} for rows in (items["detail"], ~items["detail"]))
        of = trains["markers"]
        place = np.arange(len(of)) - np.searchsorted(of, of, "left")
        click = np.searchsorted(clicks["markers"], of, "left") + place
        known = click < np.searchsorted(clicks["markers"], of, "right")
        time = np.zeros(len(of), np.int64)
        time[known] = clicks["time_us"][click[known]]
        return {**trains, "time_us": time}, known

    def finish(self) -> Iterator[pa.RecordBatch]:
        for items in self.held:
            yield from self._as_loose(items)
        yield self._batch(RANGE, 1, {"markers": np.array([self.seen])})


def read_trains(files: DataFrame, kind: str, values: tuple[int, ...] = (), split_bytes: int | None = None) -> DataFrame:
    """Rows of CP3 or FP3 files: markers with their bytes, clicks of whole minutes, loose records, ends, ranges, errors.

    ``markers`` counts the markers of the range up to the record. ``values`` names bytes of C-POD clicks to
    return as ``v<i>``. A file that is gone or too short gives rows with ``error``.
    """
    schema = _schema(kind, values)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for split in batch.to_pylist():
                walk = _Range(kind, values, split)
                try:
                    for start, block in record_blocks(split["path"], LAYOUTS[kind], split["first"], split["n"]):
                        yield from walk.block(start, block)
                        if walk.ended:
                            break
                    yield from walk.finish()
                except Quarantine as error:
                    yield failure(schema, split["pod_file"], error)

    types = {pa.string(): "string", pa.int64(): "long", pa.int32(): "int"}
    columns = ", ".join(f"{f.name} {types[f.type]}" for f in schema)
    return spread(ranges(files, LAYOUTS[kind], split_bytes or SPLIT_BYTES)).mapInArrow(read, columns)


def read_click_counts(files: DataFrame, kind: str = "CP1", split_bytes: int | None = None) -> DataFrame:
    """(pod_file, split, markers, n, total, error): click records after each marker of a range, counted in the reader.

    ``total`` is the number of markers of the range, in one of its rows.
    """
    layout = LAYOUTS[kind]
    schema = pa.schema(
        [("pod_file", pa.string()), *((c, pa.int64()) for c in ("split", "markers", "n", "total")), ("error", pa.string())]
    )

    def row(split: dict, seen: int) -> pa.RecordBatch:
        values = {"pod_file": split["pod_file"], "split": split["no"], "markers": seen, "n": 0, "total": seen}
        return pa.RecordBatch.from_arrays([pa.array([values.get(f.name)], f.type) for f in schema], schema=schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for split in batch.to_pylist():
                seen = 0
                try:
                    for _, block in record_blocks(split["path"], layout, split["first"], split["n"]):
                        kinds = block[:, layout.type_byte - 1]
                        marked = np.cumsum(kinds == MARKER, dtype=np.int64)
                        n = np.bincount(marked[kinds < MARKER], minlength=int(marked[-1]) + 1)
                        same = [pa.repeat(pa.scalar(split[c], t), len(n)) for c, t in (("pod_file", pa.string()), ("no", pa.int64()))]
                        counts = [pa.array(seen + np.arange(len(n))), pa.array(n.astype(np.int64))]
                        yield pa.RecordBatch.from_arrays([*same, *counts, *(pa.nulls(len(n), schema.field(c).type) for c in ("total", "error"))], schema=schema)
                        seen += int(marked[-1])
                    yield row(split, seen)
                except Quarantine as error:
                    yield failure(schema, split["pod_file"], error)

    found = spread(ranges(files, layout, split_bytes or SPLIT_BYTES)).mapInArrow(
        read, "pod_file string, split long, markers long, n long, total long, error string"
    )
    return found.groupBy("pod_file", "split", "markers", "error").agg(F.sum("n").alias("n"), F.max("total").alias("total"))

"""Packing tokenized documents into sequences of a fixed length, as few as possible.

Documents become pieces of at most ``capacity`` tokens. What is packed is the histogram
of piece lengths: at most ``capacity`` rows, whatever the corpus. The plan over it is a
list of fillings (lengths that share a sequence, and how many sequences are filled so):

1. exact complements: singles, pairs and triples of lengths, indexed by their sum, fill
   the gap of the longest piece left exactly, as often as the lengths' counts allow;
2. best fit: what is left goes, longest first, into the sequence that it fills best.

Pieces are then numbered among those of their length, and each number has one slot in
the plan. Numbering is per written block with a running sum over the blocks' counts, so
that a length that a third of all pieces share is never sorted in one task. Only the
bounded histogram and plan pass through the driver.

Defined cases: a null or empty text is the single token 0. Null, equal or repeated ids
are packed as rows of their own. An empty table gives an empty result. Very long texts
are cut into full pieces, each of which is a sequence. Extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratamill.llm.tokens import TOKENIZER, chunks, forget, ids_of, tokenizer_path
from stratamill.sinks.written import written_once

CAPACITY = 2048
END = 0
# Text tokenized at a time; its ids and their places take some thirty times as much memory.
CHUNK_BYTES = 2 << 20

PIECE_SCHEMA = (
    "doc_id {key}, piece int, start long, length long, ids_crc32 long, {ids}_block int, _number long"
)


def pieces(df: DataFrame, key: str, text: str, capacity: int, tokenizer: str, with_ids: bool) -> DataFrame:
    """A row per piece; ``_number`` counts the pieces of its length within its block (task)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block, counted = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        path = tokenizer_path(tokenizer)
        for batch in chunks(batches, 1, CHUNK_BYTES):
            found, starts = ids_of(batch.column(1), path)
            starts = starts + np.arange(len(starts))
            ids = np.full(starts[-1], END, "<u4")
            is_end = np.zeros(len(ids), bool)
            is_end[starts[1:] - 1] = True
            ids[~is_end] = found
            sizes = np.diff(starts)
            counts = -(-sizes // capacity)
            row = np.repeat(np.arange(len(sizes)), counts)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
            start = nth * capacity
            length = np.minimum(sizes[row] - start, capacity)
            first = starts[row] + start
            crc = [zlib.crc32(ids[a : a + n]) for a, n in zip(first.tolist(), length.tolist(), strict=True)]
            order = np.argsort(length, kind="stable")
            ordered = length[order]
            new = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
            within = np.arange(len(ordered)) - np.repeat(new, np.diff(np.append(new, len(ordered))))
            number = np.empty(len(length), np.int64)
            number[order] = within + counted[ordered]
            counted += np.bincount(length, minlength=capacity + 1)
            columns = [
                batch.column(0).take(pa.array(row)),
                pa.array(nth, pa.int32()),
                pa.array(start, pa.int64()),
                pa.array(length, pa.int64()),
                pa.array(crc, pa.int64()),
            ]
            if with_ids:
                offsets = pa.array(np.append(first, starts[-1]), pa.int32())
                columns.append(pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32))))
            columns += [pa.array(np.full(len(row), block), pa.int32()), pa.array(number, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids, "_block", "_number"]
            yield pa.RecordBatch.from_arrays(columns, names=names)
        forget(path)

    schema = PIECE_SCHEMA.format(key=dict(df.dtypes)[key], ids="ids array<int>, " if with_ids else "")
    return df.select(key, text).mapInArrow(cut, schema)


class Fillings:
    """Lengths that share a sequence, and how many sequences are filled so."""

    def __init__(self, capacity: int, counts: dict[int, int]):
        self.capacity = capacity
        self.left = np.zeros(capacity + 1, np.int64)
        for length, count in counts.items():
            self.left[length] = count
        self.found: list[tuple[tuple[int, ...], int]] = []

    def _use(self, lengths: tuple[int, ...]) -> None:
        """Fill as many sequences with these lengths as their counts allow."""
        kinds, needs = np.unique(lengths, return_counts=True)
        times = int((self.left[kinds] // needs).min())
        if times:
            self.left[kinds] -= times * needs
            self.found.append((lengths, times))

    def _pair(self, total: int, below: int) -> tuple[int, int] | None:
        """Two lengths left that sum to ``total``, none above ``below``; the largest first."""
        a = np.arange(max(1, -(-total // 2)), min(total - 1, below) + 1)
        if not len(a):
            return None
        b = total - a
        good = (self.left[a] > 0) & (self.left[b] > 0) & ((a != b) | (self.left[a] > 1))
        at = np.flatnonzero(good)
        return (int(a[at[-1]]), int(b[at[-1]])) if len(at) else None

    def exact(self) -> None:
        """Combinations that fill a sequence exactly, for the longest length left first."""
        for longest in range(self.capacity, 0, -1):
            while self.left[longest]:
                before = self.left[longest]
                for lengths in self._complements(longest):
                    self._use(lengths)
                    break
                if self.left[longest] == before:
                    break

    def _complements(self, longest: int) -> Iterator[tuple[int, ...]]:
        gap = self.capacity - longest
        self.left[longest] -= 1  # the piece whose gap is filled
        try:
            found: tuple[int, ...] | None = None
            if gap == 0:
                found = ()
            elif gap <= longest and self.left[gap]:
                found = (gap,)
            elif pair := self._pair(gap, longest):
                found = pair
            else:
                for third in np.flatnonzero(self.left[1 : min(gap - 1, longest + 1)])[::-1] + 1:
                    self.left[third] -= 1
                    pair = self._pair(gap - int(third), int(third))
                    self.left[third] += 1
                    if pair:
                        found = (int(third), *pair)
                        break
        finally:
            self.left[longest] += 1
        if found is not None:
            yield (longest, *found)

    def best_fit(self) -> None:
        """The lengths left, longest first, each into the fullest open filling that has room.

        Open sequences of equal content are handled together, so the work follows the
        number of lengths, not of pieces.
        """
        room: dict[int, list[tuple[tuple[int, ...], int]]] = {}
        for length in range(self.capacity, 0, -1):
            todo = int(self.left[length])
            self.left[length] = 0
            while todo:
                gap = min((g for g in room if g >= length), default=None)
                if gap is None:
                    each = min(self.capacity // length, todo)
                    self._open(room, (length,) * each, todo // each)
                    todo %= each
                    continue
                content, times = room[gap].pop()
                if not room[gap]:
                    del room[gap]
                fits = min(gap // length, todo)
                if fits and todo >= fits * times:
                    self._open(room, (*content, *(length,) * fits), times)
                    todo -= fits * times
                else:
                    used = todo // fits
                    self._open(room, (*content, *(length,) * fits), used)
                    todo -= fits * used
                    if times > used:
                        self._open(room, content, times - used)
        for group in room.values():
            self.found.extend(group)

    def _open(self, room: dict, content: tuple[int, ...], times: int) -> None:
        gap = self.capacity - sum(content)
        if gap:
            room.setdefault(gap, []).append((content, times))
        else:
            self.found.append((content, times))


def plan(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Fillings for a histogram of lengths (1 to ``capacity``); every piece is in exactly one."""
    fillings = Fillings(capacity, counts)
    fillings.exact()
    fillings.best_fit()
    return fillings.found


def slots(fillings: list[tuple[tuple[int, ...], int]], capacity: int) -> dict[int, tuple[np.ndarray, ...]]:
    """By length: numbers from which a run of slots begins, its first sequence, and its offset.

    The run's k-th number lies in the run's k-th sequence, at that offset.
    """
    rows: dict[int, list[tuple[int, int, int]]] = {}
    used = np.zeros(capacity + 1, np.int64)
    sequence = 0
    for content, times in fillings:
        offset = 0
        for length in content:
            rows.setdefault(length, []).append((int(used[length]), sequence, offset))
            used[length] += times
            offset += length
        sequence += times
    return {length: tuple(np.array(column, np.int64) for column in zip(*r, strict=True)) for length, r in rows.items()}


def pack(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    tokenizer: str = TOKENIZER,
    with_ids: bool = True,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset and, if asked for, ids.

    ``key`` becomes ``doc_id``. The pieces of one ``sequence_id`` lie at gapless offsets
    from 0 and hold ``capacity`` tokens at most.
    """
    cut = written_once(pieces(df, key, text, capacity, tokenizer, with_ids))
    by_block = cut.groupBy("_block", "length").agg(F.count("*").alias("n"))
    by_block = written_once(by_block)
    histogram = {row["length"]: row["n"] for row in by_block.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = slots(plan(histogram, capacity), capacity)
    before = Window.partitionBy("length").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    firsts = by_block.select("_block", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_first"))
    numbered = cut.join(firsts, ["_block", "length"])
    own = "ids array<int>, " if with_ids else ""
    schema = (
        f"doc_id {dict(cut.dtypes)['doc_id']}, piece int, start long, length long, ids_crc32 long, {own}"
        "sequence_id long, offset long"
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            number = batch.column("_n").to_numpy()
            sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            kinds, at = np.unique(length[order], return_index=True)
            for kind, part in zip(kinds, np.split(order, at[1:]), strict=True):
                begins, sequences, offsets = places[int(kind)]
                run = np.searchsorted(begins, number[part], "right") - 1
                sequence[part] = sequences[run] + number[part] - begins[run]
                offset[part] = offsets[run]
            names = [n for n in batch.schema.names if n != "_n"]
            columns = [batch.column(n) for n in names] + [pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "sequence_id", "offset"])

    columns = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]
    return numbered.select(*columns, (F.col("_number") + F.col("_first")).alias("_n")).mapInArrow(place, schema)

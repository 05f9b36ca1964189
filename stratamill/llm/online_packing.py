"""Packing tokenized documents online, with a fixed number of open windows per task.

1. Every task reads its documents once. Full windows of a long document are sequences of
   their own; the rest of it goes into the open window that it fills best. Where none
   has room and no more may be opened, the fullest is emitted: the document's head fills
   its gap first, unless that is less than ``LEAST_CUT`` tokens, which are padded.
2. The windows left open are merged: those of ``FAN`` tasks are packed together in the
   same way, and so on until one group is left, whose last windows are filled by cutting
   freely. What remains is less than a sequence and is cut at powers of two, which need
   no padding.

A task holds ``WINDOWS`` windows and the ids of one document; a merge reads at most
``FAN * WINDOWS`` windows. Nothing is sorted or shuffled but the windows left open, and
nothing passes through the driver but the number of tasks. Places follow from the task
and the order of its rows, so a task that is run again gives the same ones.

Defined cases: a null or empty text is the single token 0. Null, equal or repeated ids
are packed as rows of their own. An empty table gives an empty result. Very long texts
are tokenized in slices and cut into full windows. Extra columns are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import deque
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamill.llm.byte_tokens import TOKENIZER, byte_ids
from stratamill.llm.tokens import chunks, tokenizer_path
from stratamill.sinks.written import written_once

CAPACITY = 1024
WINDOWS = 32
LEAST_CUT = 8
FAN = 8
END = 0
# Sequence numbers of a task or merge group; its number stands above them, and the round above that.
_OWN_BITS, _GROUP_BITS = 32, 26
_CHUNK_BYTES = 4 << 20
_ROWS = 4096


class Piece(NamedTuple):
    key: object
    start: int
    ids: np.ndarray
    doc_tokens: int

    def cut(self, at: int) -> tuple[Piece, Piece]:
        return self._replace(ids=self.ids[:at]), self._replace(start=self.start + at, ids=self.ids[at:])


class Windows:
    """Open windows, best fit first; a finished window is a list of pieces."""

    def __init__(self, capacity: int, most: int, least_cut: int):
        self.capacity, self.most, self.least_cut = capacity, most, least_cut
        self.gaps: list[tuple[int, int]] = []
        self.content: dict[int, list[Piece]] = {}
        self.opened = 0

    def _open(self, pieces: list[Piece], gap: int) -> None:
        insort(self.gaps, (gap, self.opened))
        self.content[self.opened] = pieces
        self.opened += 1

    def add(self, piece: Piece) -> Iterator[list[Piece]]:
        """Place a piece of any length; what is finished by that comes back."""
        while len(piece.ids) >= self.capacity:
            full, piece = piece.cut(self.capacity)
            yield [full]
        size = len(piece.ids)
        while size:
            at = bisect_left(self.gaps, (size, -1))
            if at < len(self.gaps):
                gap, window = self.gaps.pop(at)
                self.content[window].append(piece)
                if gap == size:
                    yield self.content.pop(window)
                else:
                    insort(self.gaps, (gap - size, window))
                return
            if len(self.gaps) < self.most:
                self._open([piece], self.capacity - size)
                return
            gap, window = self.gaps.pop(0)
            done = self.content.pop(window)
            if gap >= self.least_cut:
                head, piece = piece.cut(gap)
                done.append(head)
                size = len(piece.ids)
            yield done

    def left(self) -> list[list[Piece]]:
        """The open windows, the fullest first."""
        return [self.content[window] for _, window in self.gaps]

    def close(self) -> Iterator[list[Piece]]:
        """Fill the open windows, fullest first, from the emptiest; the last is cut at powers of two."""
        windows = deque(self.left())
        while windows:
            window = windows.popleft()
            gap = self.capacity - sum(len(piece.ids) for piece in window)
            while gap and windows:
                piece = windows[-1].pop()
                if len(piece.ids) > gap:
                    piece, rest = piece.cut(gap)
                    windows[-1].append(rest)
                elif not windows[-1]:
                    windows.pop()
                window.append(piece)
                gap -= len(piece.ids)
            yield from powers_of_two(window) if gap else [window]


def powers_of_two(window: list[Piece]) -> Iterator[list[Piece]]:
    """The pieces as windows whose sizes are different powers of two, the largest first."""
    left = sum(len(piece.ids) for piece in window)
    rest = deque(window)
    while left:
        size = 1 << (left.bit_length() - 1)
        left -= size
        part = []
        while size:
            piece = rest.popleft()
            if len(piece.ids) > size:
                piece, later = piece.cut(size)
                rest.appendleft(later)
            part.append(piece)
            size -= len(piece.ids)
        yield part


class _Rows:
    """Rows of placed pieces, handed on as batches."""

    NAMES = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "group", "open", "ids")

    def __init__(self, key_type: pa.DataType, group: int, first: int, with_ids: bool):
        self.key_type, self.group, self.next, self.with_ids = key_type, group, first, with_ids
        self.rows: list[tuple] = []

    def put(self, window: list[Piece], is_open: bool = False) -> None:
        offset = 0
        for key, start, ids, doc_tokens in window:
            crc = zlib.crc32(ids)
            kept = ids if is_open or self.with_ids else None
            self.rows.append((key, start, len(ids), crc, doc_tokens, self.next, offset, self.group, is_open, kept))
            offset += len(ids)
        self.next += 1

    def batches(self, least: int) -> Iterator[pa.RecordBatch]:
        if len(self.rows) < max(least, 1):
            return
        columns = list(zip(*self.rows, strict=True))
        self.rows = []
        kinds = [self.key_type, *[pa.int64()] * 6, pa.int32(), pa.bool_()]
        arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=False)]
        arrays.append(pa.array([None if ids is None else ids.view("<i4") for ids in columns[-1]], pa.list_(pa.int32())))
        yield pa.RecordBatch.from_arrays(arrays, names=self.NAMES)


def _schema(key_type: str) -> str:
    return (
        f"doc_id {key_type}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
        "group int, open boolean, ids array<int>"
    )


def packed_by_task(
    df: DataFrame, key: str, text: str, capacity: int, tokenizer: str, windows: int, least_cut: int, with_ids: bool
) -> DataFrame:
    """Placed pieces; those of windows left open have ``open`` set and their ids with them."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        encoder, state, rows = byte_ids(tokenizer_path(tokenizer)), Windows(capacity, windows, least_cut), None
        for batch in chunks(batches, 1, _CHUNK_BYTES):
            rows = rows or _Rows(batch.schema.field(0).type, task, task << _OWN_BITS, with_ids)
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.append(encoder.of(value.as_py() or ""), np.uint32(END)).astype("<u4", copy=False)
                for window in state.add(Piece(doc, 0, ids, len(ids))):
                    rows.put(window)
                yield from rows.batches(_ROWS)
        if rows:
            for window in state.left():
                rows.put(window, is_open=True)
            yield from rows.batches(1)

    return df.select(key, text).mapInArrow(place, _schema(dict(df.dtypes)[key]))


def merged(left: DataFrame, round_no: int, groups: int, capacity: int, windows: int, least_cut: int, with_ids: bool) -> DataFrame:
    """Open windows packed together, ``FAN`` groups at a time; the only group left is closed."""
    key_type = dict(left.dtypes)["doc_id"]

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, state, rows = None, None, None

        def finish() -> Iterator[pa.RecordBatch]:
            if state:
                for window in state.close() if groups == 1 else state.left():
                    rows.put(window, is_open=groups > 1)
                yield from rows.batches(1)

        for batch in batches:
            fields = {name: batch.column(name) for name in ("doc_id", "start", "doc_tokens", "group", "ids")}
            for i in range(batch.num_rows):
                doc, start, doc_tokens, own = (fields[n][i].as_py() for n in ("doc_id", "start", "doc_tokens", "group"))
                if own != group:
                    yield from finish()
                    group, state = own, Windows(capacity, windows, least_cut)
                    first = ((round_no << _GROUP_BITS) + own) << _OWN_BITS
                    rows = _Rows(batch.schema.field(0).type, own, first, with_ids)
                ids = fields["ids"][i].values.to_numpy(zero_copy_only=False).view("<u4")
                for window in state.add(Piece(doc, start, ids, doc_tokens)):
                    rows.put(window)
                yield from rows.batches(_ROWS)
        yield from finish()

    own = F.floor(F.col("group") / FAN).cast("int").alias("group")
    rows = left.select("doc_id", "start", "doc_tokens", own, "ids", "sequence_id", "offset")
    dealt = rows.repartition(groups, "group").sortWithinPartitions("group", "sequence_id", "offset")
    return dealt.mapInArrow(merge, _schema(key_type))


def pack_online(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    tokenizer: str = TOKENIZER,
    windows: int = WINDOWS,
    least_cut: int = LEAST_CUT,
    with_ids: bool = True,
) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if asked for, ids.

    ``key`` becomes ``doc_id``. The pieces of one ``sequence_id`` lie at gapless offsets
    from 0 and hold ``capacity`` tokens at most.
    """
    packed = written_once(packed_by_task(df, key, text, capacity, tokenizer, windows, least_cut, with_ids))
    last = packed.where("open").agg(F.max("group").alias("last")).first()["last"]
    done, round_no = [packed.where("not open")], 0
    groups = 0 if last is None else last + 1
    while groups:
        round_no, groups = round_no + 1, -(-groups // FAN)
        packed = written_once(merged(packed.where("open"), round_no, groups, capacity, windows, least_cut, with_ids))
        done.append(packed.where("not open"))
        groups = 0 if groups == 1 else groups
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *["ids"] * with_ids]
    every = done[0]
    for more in done[1:]:
        every = every.unionByName(more)
    return every.select(*columns)

"""Packing of token sequences by sums of squares."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from surveysieve.llm.common import pick, slices, texts_of
from surveysieve.llm.tokenizer import word_ids

SCHEMA = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, "
    "sequence_id long, offset long, sequence_length long"
)

# Partially filled windows a task holds at most; beyond that they are merged and written.
OPEN_WINDOWS = 4096

# A piece: document id, start in the document, ids as bytes, ids of the document.
Piece = tuple[int | None, int, bytes, int]


class SquaresPacker:
    """Places items online, so that the sum over levels of (windows at that level)^2 grows least.

    ``counts[level]`` is the number of partially filled windows that hold
    ``level`` ids; empty and full windows do not count. Of equally good levels
    the fullest is taken. ``finish`` merges what is still open: the emptiest
    windows' pieces fill the fullest windows, cut where a window ends, and the
    last window's ids go to sequences whose lengths are powers of two. So no
    sequence needs padding.
    """

    def __init__(self, width: int):
        self.width = width
        self.counts = np.zeros(width + 1, dtype=np.int64)
        self.open: dict[int, list[list[Piece]]] = {}
        self.n_open = 0

    def level_for(self, size: int) -> int:
        """The level to place ``size`` ids at, less than the width; 0 opens a window."""
        counts = self.counts
        levels = np.flatnonzero(counts[: self.width - size + 1])
        if not len(levels):
            return 0
        # The sum of squares grows by this; a window that becomes full leaves the levels.
        growth = 2 * (counts[levels + size] - counts[levels]) + 2
        growth[levels == self.width - size] -= 1
        best = len(levels) - 1 - int(np.argmin(growth[::-1]))
        return int(levels[best]) if growth[best] <= 2 * counts[size] + 1 else 0

    def add(self, piece: Piece) -> list[list[Piece]]:
        """Places a piece of at most ``width`` ids; returns the window if it is full now."""
        size = len(piece[2]) // 4
        if size == self.width:
            return [[piece]]
        level = self.level_for(size)
        if level:
            window = self.open[level].pop()
            self.counts[level] -= 1
            self.n_open -= 1
        else:
            window = []
        window.append(piece)
        if level + size == self.width:
            return [window]
        self.counts[level + size] += 1
        self.n_open += 1
        self.open.setdefault(level + size, []).append(window)
        return self.finish(keep_last=True) if self.n_open > OPEN_WINDOWS else []

    def finish(self, keep_last: bool = False) -> list[list[Piece]]:
        """Full windows from all open ones. What is left over stays open, or is cut to powers of two."""
        rest = [(level, window) for level in sorted(self.open, reverse=True) for window in self.open[level]]
        self.open, self.n_open = {}, 0
        self.counts[:] = 0
        full, first, last = [], 0, len(rest) - 1
        stock: list[Piece] = []
        while first <= last:
            level, window = rest[first]
            first += 1
            while level < self.width:
                if not stock:
                    if first > last:
                        break
                    stock = rest[last][1]
                    last -= 1
                piece = stock.pop()
                room = self.width - level
                size = len(piece[2]) // 4
                if size > room:
                    doc_id, start, ids, total = piece
                    stock.append((doc_id, start + room, ids[4 * room :], total))
                    piece, size = (doc_id, start, ids[: 4 * room], total), room
                window.append(piece)
                level += size
            if level == self.width:
                full.append(window)
                if first > last and stock:
                    rest, first, last, stock = [(_ids(stock), stock)], 0, 0, []
            elif keep_last:
                self.open[level] = [window]
                self.counts[level], self.n_open = 1, 1
            else:
                full += _powers_of_two(window)
        return full


def _ids(pieces: list[Piece]) -> int:
    return sum(len(piece[2]) for piece in pieces) // 4


def _powers_of_two(window: list[Piece]) -> list[list[Piece]]:
    """Cuts a window into sequences whose lengths are the powers of two that its length consists of."""
    pieces, total, out = window[::-1], _ids(window), []
    while total:
        room = 1 << (total.bit_length() - 1)
        total -= room
        own = []
        while room:
            doc_id, start, ids, n = pieces.pop()
            size = min(room, len(ids) // 4)
            own.append((doc_id, start, ids[: 4 * size], n))
            if 4 * size < len(ids):
                pieces.append((doc_id, start + size, ids[4 * size :], n))
            room -= size
        out.append(own)
    return out


def pack(docs: DataFrame, tokenizer: str, width: int = 2048, end_id: int = 1) -> DataFrame:
    """Token sequences of at most ``width`` ids from the whole texts of ``docs`` (doc_id, text).

    One row per piece: ``doc_id``, ``start`` (the document's ids before it),
    ``length``, ``ids`` (little-endian unsigned 32-bit integers), ``doc_tokens``
    (with the end id), ``sequence_id``, ``offset`` in the sequence, and
    ``sequence_length``. Documents longer than a window fill windows of their
    own, and their rest is placed like a short document. Each partition of
    ``docs`` is packed by itself, in one pass, without a shuffle.

    A null text is empty; an empty text is its end id alone. A null doc_id stays
    null. Repeated rows are packed once each. No rows give no rows. ``width``
    must be a power of two, so that nothing is padded. Other columns are ignored.
    """
    if width < 1 or width & (width - 1):
        raise ValueError("width must be a power of two")
    end = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, windows = SquaresPacker(width), []
        number = TaskContext.get().partitionId() << 33
        for batch in slices(batches):
            texts = texts_of(batch.column(1))
            for doc_id, ids in zip(batch.column(0).to_pylist(), word_ids(tokenizer, texts), strict=True):
                ids += end
                total = len(ids) // 4
                for start in range(0, total, width):
                    piece = (doc_id, start, ids[4 * start : 4 * (start + width)], total)
                    windows += packer.add(piece)
            if len(windows) >= SLICE_WINDOWS:
                yield _rows(windows, number)
                number += len(windows)
                windows = []
        windows += packer.finish()
        for first in range(0, len(windows), SLICE_WINDOWS):
            block = windows[first : first + SLICE_WINDOWS]
            yield _rows(block, number)
            number += len(block)

    return pick(docs, "doc_id", "text").mapInArrow(run, SCHEMA)


SLICE_WINDOWS = 256


def _rows(windows: list[list[Piece]], first: int) -> pa.RecordBatch:
    rows = []
    for number, window in enumerate(windows, first):
        offset, length = 0, _ids(window)
        for doc_id, start, ids, total in window:
            size = len(ids) // 4
            rows.append((doc_id, start, size, ids, total, number, offset, length))
            offset += size
    types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    names = [field.split()[0] for field in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

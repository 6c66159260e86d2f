"""Packing documents into windows of 2048 tokens by the sum-of-squares rule.

Each task packs the documents of its partition online. A document's full windows
are cut off and stand alone; the rest is one item. ``levels[h]`` counts the open
windows filled up to ``h``; the item goes to the fill level (or a new window) that
makes the sum of the squared counts smallest, which keeps all fill levels in
stock, so that later items find a window they close exactly. Windows still open
at the end of a partition are put together by best fit; what the fullest of them
then lack is cut from the emptiest, and the last ids are cut into powers of two,
which need no padding.

Only open windows hold token ids, so a task's memory does not grow with its rows.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import ship_package
from basketry.llm.tokens import VOCABULARY, encoder

WINDOW = 2048
END_ID = 1
SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, recut boolean"
)
# sequence ids of a partition start at partition << SEQUENCE_BITS
SEQUENCE_BITS = 40


class SumOfSquares:
    """Online packer of one partition; ``take`` and ``finish`` return closed windows.

    A piece is (doc_id, start, ids, doc_tokens, recut); a window is a list of
    pieces; ``recut`` marks those cut from where the rule had put them.
    """

    def __init__(self, window: int = WINDOW):
        self.window = window
        self.levels = np.zeros(window + 1, np.int64)
        self._open: list[list[list]] = [[] for _ in range(window + 1)]

    def level_for(self, size: int) -> int:
        """The fill level to put an item of ``size`` on; 0 is a new window.

        Moving a window from h to h + size changes the sum of squares by
        2 (n[h + size] - n[h]) + 2; a closed window leaves the count, a new one
        has no old level. Of equal changes the fullest window wins.
        """
        n, room = self.levels, self.window - size
        change = 2 * (n[size : self.window + 1] - n[: room + 1]) + 2
        change[room] = 1 - 2 * n[room]
        change[n[: room + 1] == 0] = np.iinfo(np.int64).max
        change[0] = 2 * n[size] + 1
        return room - int(np.argmin(change[::-1]))

    def take(self, piece: tuple) -> list[list]:
        size = len(piece[2])
        if size == self.window:
            return [[piece]]
        h = self.level_for(size)
        pieces = self._open[h].pop() if h else []
        self.levels[h] -= bool(h)
        pieces.append(piece)
        if h + size == self.window:
            return [pieces]
        self._open[h + size].append(pieces)
        self.levels[h + size] += 1
        return []

    def finish(self) -> list[list]:
        """The open windows: whole ones put together by best fit, fullest first,
        then the fullest filled up from the emptiest, the rest in powers of two."""
        left = [(fill, pieces) for fill in range(self.window, 0, -1) for pieces in self._open[fill]]
        self._open = [[] for _ in range(self.window + 1)]
        self.levels[:] = 0
        closed = []
        for fill, pieces in left:
            fits = np.flatnonzero(self.levels[: self.window - fill + 1])
            found = int(fits[-1]) if len(fits) else 0
            if found:
                self.levels[found] -= 1
                pieces = self._open[found].pop() + pieces
            if found + fill == self.window:
                closed.append(pieces)
            else:
                self._open[found + fill].append(pieces)
                self.levels[found + fill] += 1
        left = deque(pieces for stack in reversed(self._open) for pieces in stack)
        self._open = [[] for _ in range(self.window + 1)]
        self.levels[:] = 0
        total = sum(len(p[2]) for pieces in left for p in pieces)
        while total >= self.window:
            pieces = left.popleft()
            pieces += self._cut(left, self.window - sum(len(p[2]) for p in pieces))
            closed.append(pieces)
            total -= self.window
        while total:  # powers of two, largest first
            size = 1 << (total.bit_length() - 1)
            closed.append(self._cut(left, size))
            total -= size
        return closed

    @staticmethod
    def _cut(windows: deque, size: int) -> list[tuple]:
        """``size`` ids from the ends of the last windows."""
        out = []
        while size:
            doc_id, start, ids, total, recut = windows[-1].pop()
            keep = max(0, len(ids) - size)
            out.append((doc_id, start + keep, ids[keep:], total, True))
            if keep:
                windows[-1].append((doc_id, start, ids[:keep], total, recut))
            elif not windows[-1]:
                windows.pop()
            size -= len(ids) - keep
        return out


def _pack(vocabulary: str, window: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        packer = SumOfSquares(window)
        sequence = TaskContext.get().partitionId() << SEQUENCE_BITS

        def rows(windows: list[list]) -> list[tuple]:
            nonlocal sequence
            out = []
            for pieces in windows:
                offset = 0
                for doc_id, start, ids, total, recut in pieces:
                    out.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, sequence, offset, recut))
                    offset += len(ids)
                sequence += 1
            return out

        def batch(out: list[tuple]) -> pa.RecordBatch:
            names = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "recut")
            kinds = [pa.int64()] * 7 + [pa.bool_()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)

        for b in batches:
            out = []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                ids = np.append(encode.ids(text.as_py() or ""), np.uint32(END_ID))
                for start in range(0, len(ids), window):
                    # a copy: a view would keep the whole document's ids
                    out += rows(packer.take((doc_id, start, ids[start : start + window].copy(), len(ids), False)))
            if out:
                yield batch(out)
        if out := rows(packer.finish()):
            yield batch(out)

    return pack


def pack(docs: DataFrame, vocabulary: str = VOCABULARY, window: int = WINDOW) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset, recut`` (cut at the end of a partition, see :class:`SumOfSquares`).

    A document is its text's ids and one end id; a null or empty text is the end
    id alone. Every id lies in exactly one piece, every sequence is gapless from
    offset 0 and holds ``window`` ids or a power of two. Repeated rows are
    documents of their own; null ids stay null. No rows give no pieces; other
    columns are not read. A text's ids are held once while it is cut. Nothing
    is shuffled; a lost task packs its partition again to the same result.
    """
    ship_package(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_pack(vocabulary, window), SCHEMA)

"""Packing documents into windows by sum of squares.

Every document is its token ids and an end id.  What fills whole windows is
cut off first; the rest goes, as documents arrive, to the fill level for
which the sum of squared counts of partially filled windows grows least
(an empty window counts as a level, too); ties take the fullest.  The
counts are one array by level, so a step does not depend on the number of
open windows.  When a task's documents are through, or ``max_open`` windows
are open, the windows still open are poured together: the emptiest are cut
up to fill the fullest, which leaves one partial window.

A task packs the rows it reads and holds the ids of its open windows only.
Nulls and empty texts: the end id alone.  Repeated rows: each is packed.
No rows: no pieces.  ``sequence_id``: task number * 2**40 + window number.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .token_files import encoder
from .token_ids import BYTE_LEVEL

WINDOW = 2048
COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


class Piece:
    """Ids ``start``.. of a document."""

    __slots__ = ("doc", "start", "ids", "total")

    def __init__(self, doc, start: int, ids: np.ndarray, total: int) -> None:
        self.doc, self.start, self.ids, self.total = doc, start, ids, total

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return Piece(self.doc, self.start, self.ids[:n], self.total), Piece(self.doc, self.start + n, self.ids[n:], self.total)


class SumOfSquares:
    """Windows of one task; ``out`` gets each closed window's pieces."""

    def __init__(self, window: int, max_open: int) -> None:
        self.window, self.max_open = window, max_open
        self.count = np.zeros(window + 1, np.int64)  # open windows by level
        self.at: dict[int, list[list[Piece]]] = {}
        self.open = 0
        self.out: list[list[Piece]] = []

    def add(self, doc, ids: np.ndarray) -> None:
        whole = len(ids) // self.window * self.window
        for lo in range(0, whole, self.window):
            self.out.append([Piece(doc, lo, ids[lo : lo + self.window], len(ids))])
        if len(ids) > whole:
            # a copy, so that a held piece doesn't hold its whole batch
            self._place(Piece(doc, whole, ids[whole:].copy(), len(ids)))
        if self.open > self.max_open:
            self.pour()

    def _level(self, size: int) -> int:
        """The fill level to put ``size`` ids on; 0: a new window."""
        top = self.window - size
        levels = np.flatnonzero(self.count[1 : top + 1]) + 1
        if not len(levels):
            return 0
        growth = 1 - 2 * self.count[levels] + np.where(levels < top, 2 * self.count[levels + size] + 1, 0)
        best = len(levels) - 1 - int(np.argmin(growth[::-1]))
        new = 2 * self.count[size] + 1
        return int(levels[best]) if growth[best] <= new else 0

    def _place(self, piece: Piece) -> None:
        size = len(piece.ids)
        level = self._level(size)
        if level:
            pieces = self.at[level].pop()
            self.count[level] -= 1
            self.open -= 1
        else:
            pieces = []
        pieces.append(piece)
        if level + size == self.window:
            self.out.append(pieces)
            return
        self.at.setdefault(level + size, []).append(pieces)
        self.count[level + size] += 1
        self.open += 1

    def pour(self) -> None:
        """Closes all open windows, cutting the emptiest to fill the others."""
        windows = [pieces for level in sorted(self.at) for pieces in self.at[level]]
        space = [self.window - sum(len(p.ids) for p in pieces) for pieces in windows]
        loose: list[Piece] = []
        low, high = 0, len(windows)
        while low < high:
            high -= 1
            gap = space[high]
            while gap and (loose or low < high):
                if not loose:
                    loose = windows[low][::-1]
                    low += 1
                piece = loose.pop()
                if len(piece.ids) > gap:
                    piece, rest = piece.cut(gap)
                    loose.append(rest)
                windows[high].append(piece)
                gap -= len(piece.ids)
            self.out.append(windows[high])
        last: list[Piece] = []
        room = self.window
        while loose:
            piece = loose.pop()
            if len(piece.ids) > room:
                piece, rest = piece.cut(room)
                loose.append(rest)
            last.append(piece)
            room -= len(piece.ids)
            if not room or not loose:
                self.out.append(last)
                last, room = [], self.window
        self.count[:] = 0
        self.at, self.open = {}, 0


def pack_documents(
    docs: DataFrame, tokenizer: str, layout: str = BYTE_LEVEL, window: int = WINDOW, end_id: int = 1, max_open: int = 8192, with_ids: bool = False
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset; ``with_ids`` adds the ids themselves, from which
    ``sequences`` puts the windows together."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 40
        encode, state, done = encoder(tokenizer, layout, end_id), SumOfSquares(window, max_open), 0

        def rows(doc_type: pa.DataType) -> Iterator[pa.RecordBatch]:
            nonlocal done
            cells: list[tuple] = []
            for pieces in state.out:
                offset = 0
                for p in pieces:
                    cells.append((p.doc, p.start, len(p.ids), zlib.crc32(p.ids.astype("<u4").tobytes()), p.total, task + done, offset, p.ids.tolist() if with_ids else None))
                    offset += len(p.ids)
                done += 1
            state.out = []
            if cells:
                columns = list(zip(*cells, strict=True))
                arrays = [pa.array(columns[0], doc_type), *(pa.array(c, pa.int64()) for c in columns[1:7])]
                if with_ids:
                    arrays.append(pa.array(columns[7], pa.list_(pa.int64())))
                yield pa.record_batch(arrays, names=COLUMNS + ["ids"] * with_ids)

        doc_type = pa.int64()
        for b in batches:
            doc_type = b.schema.field(0).type
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                ids, at = encode(part.column(1).to_pylist())
                for doc, start, end in zip(part.column(0).to_pylist(), at[:-1].tolist(), at[1:].tolist(), strict=True):
                    state.add(doc, ids[start:end])
                yield from rows(doc_type)
        state.pour()
        yield from rows(doc_type)

    schema = f"doc_id {kind}, " + ", ".join(f"{c} bigint" for c in COLUMNS[1:]) + ", ids array<bigint>" * with_ids
    return docs.select("doc_id", "text").mapInArrow(pack, schema)


def sequences(pieces: DataFrame, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """One row per window from pieces with ids: sequence_id, n_tokens, and
    ids padded to ``window``, except where their number is a power of two."""
    laid = F.sort_array(F.collect_list(F.struct("offset", "ids")))  # at most ``window`` ids
    rows = pieces.groupBy("sequence_id").agg(laid.alias("laid"), F.sum("length").cast("int").alias("n_tokens"))
    flat = F.flatten(F.transform("laid", lambda p: p["ids"]))
    bare = F.bit_count("n_tokens") == 1
    padded = F.concat(flat, F.array_repeat(F.lit(pad_id).cast("bigint"), F.lit(window) - F.col("n_tokens")))
    return rows.select("sequence_id", "n_tokens", F.when(bare, flat).otherwise(padded).alias("ids"))

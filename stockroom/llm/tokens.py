"""Words of Arrow text columns, found in their UTF-8 bytes.

No Python string is made for a text or a word: a slice of rows is one array
of bytes, words are spans in it and their hashes come from running sums
(``bytehash``). All separators are ASCII, so a byte tells its class.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from stockroom.llm.bytehash import SPACE, ByteHasher, windows

ROWS = 512  # rows of one slice
BYTES = 1 << 20  # text of one block; a longer row is cut at separators

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_class(*spans: tuple[int, int]) -> np.ndarray:
    """Table of 256 booleans, true inside the spans (ends included)."""
    out = np.zeros(256, dtype=bool)
    for first, last in spans:
        out[first : last + 1] = True
    return out


@dataclass
class Block:
    """Rows ``first`` to ``first + len(bounds) - 2`` of a slice, A-Z lowered:
    row ``first + k`` is ``codes[bounds[k]:bounds[k + 1]]``. A long row may
    come as several blocks."""

    first: int
    codes: np.ndarray
    bounds: np.ndarray

    def words(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(starts, ends, rows) of the maximal runs of bytes of a class."""
        n = len(self.codes)
        mask = np.zeros(n + 2, dtype=bool)
        mask[1:-1] = inside[self.codes]
        edge = np.zeros(n + 1, dtype=bool)  # a row begins or ends before this byte
        edge[self.bounds] = True
        starts = np.flatnonzero(mask[1:] & (~mask[:-1] | edge))
        ends = np.flatnonzero(mask[:-1] & (~mask[1:] | edge))
        return starts, ends, self.first + np.searchsorted(self.bounds, starts, side="right") - 1

    def hashes(self, hasher: ByteHasher, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return hasher.spans(self.codes, starts, ends)


def blocks(column: pa.Array, breaks: np.ndarray, most: int = BYTES) -> Iterator[Block]:
    """Blocks of whole rows of about ``most`` bytes. A row beyond that is cut
    behind bytes of the class ``breaks`` (null: an empty row)."""
    if len(column) == 0:
        return
    if column.null_count:
        column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    codes = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    row = 0
    while row < len(column):
        to = max(row + 1, int(np.searchsorted(bounds, bounds[row] + most, side="right")) - 1)
        at, end = int(bounds[row]), int(bounds[to])
        while end - at > most:  # one long row
            cut = _cut(codes, at + most, end, breaks)
            if cut == end:
                break
            yield Block(row, LOWER[codes[at:cut]], np.array([0, cut - at]))
            at = cut
        if to == row + 1:
            yield Block(row, LOWER[codes[at:end]], np.array([0, end - at]))
        else:
            yield Block(row, LOWER[codes[at:end]], bounds[row : to + 1] - at)
        row = to


def _cut(codes: np.ndarray, at: int, end: int, breaks: np.ndarray) -> int:
    """The place behind the first byte of ``breaks`` from ``at`` on."""
    while at < end:
        found = np.flatnonzero(breaks[codes[at : min(end, at + BYTES)]])
        if len(found):
            return at + int(found[0]) + 1
        at += BYTES
    return end


def slices(batch: pa.RecordBatch, rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    """Parts of a batch; bounds what a worker holds besides the batch."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def shingle_sets(column: pa.Array, size: int, hasher: ByteHasher) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of the shingles of ``size`` words of every row."""
    words: list[np.ndarray] = []
    for block in blocks(column, SPACE):
        starts, ends, rows = block.words(~SPACE)
        found = block.hashes(hasher, starts, ends)
        bounds = np.searchsorted(rows, np.arange(block.first, block.first + len(block.bounds)))
        for k in range(len(block.bounds) - 1):
            if block.first + k == len(words):
                words.append(found[bounds[k] : bounds[k + 1]])
            else:  # a long row goes on
                words[-1] = np.concatenate([words[-1], found[bounds[k] : bounds[k + 1]]])
    for row in words:
        yield np.unique(windows(row, size))

"""Bitmaps of fixed size over 64-bit hashes: a broadcast filter that does not
grow with the data. A hash outside the set may pass (more of them the fuller
the bitmap is), one of the set always does; what must be exact is joined
afterwards."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 26  # 8 MB
SLICE_BITS = 23


def bitmap(rows: DataFrame, value: Column, bits: int = BITS) -> np.ndarray:
    """Packed bits of all values (64-bit hashes; the top ``bits`` bits count).
    Each slice is filled by one task; the driver gets the used slices."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled: dict[int, np.ndarray] = {}
        for batch in batches:
            place = batch.column("place").to_numpy()
            for k in np.unique(place >> SLICE_BITS):
                if k not in filled:
                    filled[k] = np.zeros(1 << SLICE_BITS, dtype=bool)
                filled[k][place[(place >> SLICE_BITS) == k] & ((1 << SLICE_BITS) - 1)] = True
        packed = [np.packbits(x, bitorder="little").tobytes() for x in filled.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(filled), pa.int64()), pa.array(packed, pa.binary())], names=["slice", "part"])

    place = F.shiftrightunsigned(value, 64 - bits)
    slices = 1 << (bits - SLICE_BITS)
    dealt = rows.select(place.alias("place")).repartition(slices, F.shiftright("place", SLICE_BITS))
    out = np.zeros((slices, 1 << (SLICE_BITS - 3)), dtype=np.uint8)
    for row in dealt.mapInArrow(run, "slice long, part binary").collect():
        out[row["slice"]] = np.frombuffer(row["part"], dtype=np.uint8)
    return out.ravel()


def holds(packed: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the hashes (uint64) may be in the set."""
    bits = int(packed.size).bit_length() + 2
    place = hashes >> np.uint64(64 - bits)
    return (packed[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1

"""Sums of fixed-size vectors that the tasks of a job have gathered."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

SCHEMA = "slice int, counts binary"


def as_rows(vector: np.ndarray, slice_size: int, first: int = 0) -> pd.DataFrame:
    """Rows of SCHEMA for the non-zero slices of a task's vector (float64 or int64)."""
    parts = vector.reshape(-1, slice_size)
    used = [k for k in range(len(parts)) if parts[k].any()]
    return pd.DataFrame({"slice": [first + k for k in used], "counts": [parts[k].tobytes() for k in used]})


def summed(rows: DataFrame, slices: int, slice_size: int, dtype=np.int64) -> np.ndarray:
    """Sum of all tasks' vectors. Each slice is added up by one task that
    streams its rows; the driver gets ``slices`` rows."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, counts in zip(batch["slice"], batch["counts"], strict=True):
                sums[k] = sums.get(k, 0) + np.frombuffer(counts, dtype=dtype)
        yield pd.DataFrame({"slice": list(sums), "counts": [s.tobytes() for s in sums.values()]})

    total = np.zeros((slices, slice_size), dtype=dtype)
    for row in rows.repartition(slices, "slice").mapInPandas(add, SCHEMA).toLocalIterator():
        total[row["slice"]] = np.frombuffer(row["counts"], dtype=dtype)
    return total.ravel()

"""Size-checked broadcast of a join side.

A broadcast copies one side to every executor, so it is only safe for a
side whose size is known to be small. Spark decides this on its own for
sources with statistics (Parquet files, AQE's runtime sizes); a side built
from local rows or a long derivation has no reliable estimate and would be
sort-merge joined, which shuffles the large side by the join key -- fatal
when that key has a handful of values (one task would receive every row of
the most common one).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# About 100 bytes a row for the dimensions this applies to: ~10 MB.
BROADCAST_MAX_ROWS = 100_000


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """``broadcast(df)`` when a count shows at most ``max_rows`` rows;
    otherwise ``df`` unchanged, joined by sort-merge with AQE skew splitting.

    The count reads only this side (one number to the driver), once, when
    the plan is built.
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df

"""File feeds for the streaming jobs.

A feed is a folder of Parquet files that a file-source stream reads with
``maxFilesPerTrigger``. ``write_sliced_feed`` writes a (batch) DataFrame as
time slices, each by many tasks, appended in a locally shuffled order, so micro-batches arrive
out of event-time order (within a bounded lateness), and can finish with an
end-of-input marker row whose far-future event time moves the watermark
past every real row.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockroom.session import list_folder

END_OF_INPUT = dt.datetime(2999, 1, 1)
ROWS_PER_FILE = 1_000_000


def arrival_order(n: int) -> list[int]:
    """Slices 0..n-1 with each adjacent pair swapped: 1, 0, 3, 2, ..."""
    order: list[int] = []
    for i in range(0, n, 2):
        order.extend([i + 1, i] if i + 1 < n else [i])
    return order


def write_sliced_feed(
    df: DataFrame,
    path: str,
    time_col: str,
    slice_seconds: int,
    marker: dict | None = None,
    duplicate_every: Sequence[tuple[str, int]] = (),
    order: Sequence[int] | None = None,
    rows_per_file: int = ROWS_PER_FILE,
) -> int:
    """Append ``df`` to ``path`` one time slice after the other, in arrival
    order. Every slice is the same number of files, enough for its rows to be
    written by many tasks; a stream that reads that many files per trigger
    gets one slice in each micro-batch.

    ``marker``: column values of a final end-of-input row (its time column
    is set to END_OF_INPUT). ``duplicate_every``: (key column, m) pairs;
    rows whose key is divisible by m are written again in the next slice's
    file (duplicates for dedup tests). ``order`` overrides the arrival
    order of the slices. Returns the number of files of a slice.
    """
    epoch = F.unix_timestamp(F.col(time_col).cast("timestamp"))
    lo_hi = df.agg(F.min(epoch).alias("lo"), F.max(epoch).alias("hi")).first()
    if lo_hi["lo"] is None:
        n = 0
    else:
        n = int((lo_hi["hi"] - lo_hi["lo"]) // slice_seconds) + 1
    # written once, partitioned by slice: each feed file below reads only
    # its own partition (pruned), so the feed costs one pass over the data
    # however many slices there are
    staged_path = path.rstrip("/") + "-by-slice"
    df.withColumn("_slice", ((epoch - F.lit(lo_hi["lo"] or 0)) / slice_seconds).cast("int")).write.mode(
        "overwrite"
    ).partitionBy("_slice").parquet(staged_path)
    sliced = df.sparkSession.read.schema(
        T.StructType(list(df.schema.fields) + [T.StructField("_slice", T.IntegerType())])
    ).parquet(staged_path) if n else df.withColumn("_slice", F.lit(None).cast("int"))
    largest = sliced.groupBy("_slice").count().agg(F.max("count")).first()[0] or 0
    width = max(1, -(-largest // rows_per_file))
    for k in (order if order is not None else arrival_order(n)):
        part = sliced.filter(F.col("_slice") == k)
        for key, m in duplicate_every:
            again = sliced.filter((F.col("_slice") == k - 1) & (F.col(key) % m == 0))
            part = part.unionByName(again)
        _append(part.drop("_slice"), path, width)
    if marker is not None:
        row = {c: None for c in df.columns}
        row.update(marker)
        row[time_col] = END_OF_INPUT
        spark = df.sparkSession
        nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields])
        _append(spark.createDataFrame([tuple(row[c] for c in df.columns)], nullable), path, width)
    return width


def _files(spark: SparkSession, path: str) -> int:
    return sum(n.startswith("part-") for n in list_folder(spark, path))


def _append(part: DataFrame, path: str, width: int) -> None:
    """Append ``width`` files; a slice of fewer rows is filled up with empty ones."""
    goal = _files(part.sparkSession, path) + width
    (part.coalesce(1) if width == 1 else part.repartition(width)).write.mode("append").parquet(path)
    while _files(part.sparkSession, path) < goal:
        part.limit(0).coalesce(1).write.mode("append").parquet(path)

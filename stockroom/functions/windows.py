"""Skew-safe ordered computations: running sums, previous values, k-th rank.

A plain ``Window.partitionBy(key).orderBy(...)`` puts every row of a key in
one task; with one product or customer holding a third of all rows that task
holds a third of the data. These helpers split each key into ordered
*buckets* (an order-preserving value: the row's range partition, or a
coarse one such as the hour of the event time) and work in two levels:

1. per (key, bucket) totals -- a grouped aggregate with map-side partial
   aggregation, so a hot key costs nothing extra in the shuffle;
2. a running total over the bucket totals of each key -- one row per
   bucket, small even for a hot key;
3. the in-bucket running value over (key, bucket) partitions, offset by the
   bucket prefix from step 2.

The bucket expression must be monotone in the ordering columns: ordering by
(bucket, order_cols) must equal ordering by order_cols.

Bucket choices (``bucket`` argument):

* a Column (e.g. the hour of the event time): bounded only if no key is
  dense in one time unit;
* ``RANGE``: the index of the row's range partition over (keys, order).
  Range partitioning is monotone in its sort key, so the bucket is
  order-preserving; each (key, bucket) group is at most one balanced
  partition and a key spans at most ``spark.sql.shuffle.partitions``
  buckets, so both levels are bounded whatever the skew in key or time. The
  assignment is written once (lineage cut) so every consumer sees the same
  buckets;
* ``PLAIN``: a plain per-key window (one shuffle), for callers that have
  already bounded the largest key;
* ``None`` (default): one grouped count finds the largest key; up to
  ``hot_rows`` rows ``PLAIN``, above it ``RANGE``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockroom.session import cut_lineage

_B = "__bucket"
RANGE = "range"
PLAIN = "plain"
# Above this many rows for one key, ordered computations split the key.
HOT_KEY_ROWS = 1_000_000


def hottest_key_rows(df: DataFrame, keys: Sequence[str]) -> int:
    """Rows of the largest key (partial aggregation: cheap even when skewed)."""
    return df.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0


def bucket_mode(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_KEY_ROWS) -> str:
    """``RANGE`` if some key of ``df`` has more than ``hot_rows`` rows, else
    ``PLAIN``. Callers pass the cheapest frame that bounds the key (e.g. the
    fact table before a 1:1 dimension join), so the check does not redo
    the join."""
    return RANGE if hottest_key_rows(df, keys) > hot_rows else PLAIN


def range_buckets(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """``df`` plus ``__bucket`` = index of the row's range partition over
    (keys, order), written once so that the assignment is fixed."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *keys, *order).withColumn(_B, F.spark_partition_id())
    return cut_lineage(ranged, "range-buckets")


def _staged(df, keys, order, bucket, hot_rows) -> DataFrame | None:
    """``df`` with the bucket column, or None where a plain window is enough."""
    if bucket is None:
        if hottest_key_rows(df, keys) <= hot_rows:
            return None
        bucket = RANGE
    if isinstance(bucket, str):
        if bucket == PLAIN:
            return None
        if bucket != RANGE:
            raise ValueError(f"unknown bucket mode {bucket!r}")
        return range_buckets(df, keys, order)
    return df.withColumn(_B, bucket)


def _cols(names: Sequence[str]) -> list[Column]:
    return [F.col(n) for n in names]


def running_sums(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    values: dict[str, Column],
    bucket: Column | str | None = None,
    inclusive: bool = False,
    hot_rows: int = HOT_KEY_ROWS,
) -> DataFrame:
    """Add one running-sum column per entry of ``values``.

    ``values`` maps output name -> per-row numeric expression. With
    ``inclusive=False`` each sum covers strictly earlier rows of the key
    (0 for the first row); otherwise it includes the current row.
    """
    keys = list(keys)
    hi = 0 if inclusive else -1
    staged = _staged(df, keys, order, bucket, hot_rows)
    if staged is None:
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, hi)
        return df.select(
            "*", *[F.coalesce(F.sum(F.coalesce(e, F.lit(0))).over(w), F.lit(0)).alias(n) for n, e in values.items()]
        )
    for name, expr in values.items():
        staged = staged.withColumn("__v_" + name, F.coalesce(expr, F.lit(0)))
    part = keys + [_B]

    w_in = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, hi)
    local = staged.select(
        "*",
        *[F.coalesce(F.sum("__v_" + n).over(w_in), F.lit(0)).alias("__l_" + n) for n in values],
    )
    # ``local`` is already hash-partitioned by (keys, bucket): the bucket
    # totals reuse that shuffle instead of scanning the input again.
    totals = local.groupBy(*part).agg(
        *[F.sum("__v_" + n).alias("__t_" + n) for n in values]
    )
    w_bucket = Window.partitionBy(*keys).orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *part,
        *[F.coalesce(F.sum("__t_" + n).over(w_bucket), F.lit(0)).alias("__o_" + n) for n in values],
    )
    out = local.join(offsets, part, "left")
    for n in values:
        out = out.withColumn(n, F.col("__o_" + n) + F.col("__l_" + n))
    drop = [_B] + [p + n for n in values for p in ("__v_", "__o_", "__l_")]
    return out.drop(*drop)


def previous_value(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str,
    bucket: Column | str | None = None,
    hot_rows: int = HOT_KEY_ROWS,
) -> DataFrame:
    """``lag(value)`` over (keys ordered by ``order``), two-level.

    Within a bucket the ordinary lag is used; the first row of a bucket takes
    the value of the last row of the nearest earlier non-empty bucket.
    """
    keys = list(keys)
    part = keys + [_B]
    staged = _staged(df, keys, order, bucket, hot_rows)
    if staged is None:
        return df.withColumn(out, F.lag(value).over(Window.partitionBy(*keys).orderBy(*order)))
    w_in = Window.partitionBy(*part).orderBy(*order)
    local = staged.withColumn("__lag", F.lag(value).over(w_in)).withColumn(
        "__first", F.row_number().over(w_in) == 1
    )
    last = local.groupBy(*part).agg(
        F.max_by(F.col(value), F.struct(*_cols(order))).alias("__last")
    )
    w_b = Window.partitionBy(*keys).orderBy(_B)
    prev = last.select(*part, F.lag("__last").over(w_b).alias("__prev_bucket"))
    res = local.join(prev, part, "left").withColumn(
        out, F.when(F.col("__first"), F.col("__prev_bucket")).otherwise(F.col("__lag"))
    )
    return res.drop(_B, "__lag", "__first", "__prev_bucket")


def rank_within_limit(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    limit: Column,
    bucket: Column | str | None = None,
    out: str = "within_limit",
    hot_rows: int = HOT_KEY_ROWS,
) -> DataFrame:
    """Flag rows whose 1-based position within their key is <= ``limit``.

    ``limit`` is a per-row column (constant per key; NULL = unlimited).
    Counting is two-level: only rows in the bucket that crosses the limit
    need an in-bucket row number, and that window is bounded by the bucket.
    """
    pos = running_sums(df, keys, order, {"__before": F.lit(1)}, bucket, inclusive=False, hot_rows=hot_rows)
    return pos.withColumn(
        out, F.when(limit.isNull(), F.lit(True)).otherwise(F.col("__before") + 1 <= limit)
    ).drop("__before")


def rank_descending(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    out: str,
    bucket: str | None = None,
    hot_rows: int = HOT_KEY_ROWS,
) -> DataFrame:
    """``RANK()`` over (keys ordered by ``value`` descending, nulls last).

    Two-level: rows are counted per distinct value first, so rows with equal
    values cost no more than one; the rank of a value is one more than the
    rows of all greater values of its key, a running sum over range buckets
    of the distinct values; a join brings it back to the rows. Equal values
    are one entry, so a border between buckets never parts a tie.
    """
    keys = list(keys)
    if (bucket or bucket_mode(df, keys, hot_rows)) == PLAIN:
        order = Window.partitionBy(*keys).orderBy(F.col(value).desc_nulls_last())
        return df.withColumn(out, F.rank().over(order).cast("long"))
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"))
    # one struct as key: a null key is a key like any other
    counts = counts.withColumn("__key", F.struct(*keys))
    above = running_sums(counts, ["__key"], [F.col(value).desc_nulls_last()], {"__above": F.col("__n")}, RANGE)
    ranks = above.select(*(F.col(c).alias("__k_" + c) for c in (*keys, value)), (F.col("__above") + 1).cast("long").alias(out))
    same = F.lit(True)
    for c in (*keys, value):
        same = same & F.col(c).eqNullSafe(F.col("__k_" + c))
    return df.join(ranks, same).drop(*("__k_" + c for c in (*keys, value)))

"""Two-level (key, bucket) windows equal plain per-key windows, hot key included."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from stockroom.functions.windows import (
    HOT_KEY_ROWS,
    PLAIN,
    RANGE,
    bucket_mode,
    previous_value,
    range_buckets,
    rank_descending,
    rank_within_limit,
    running_sums,
)


def _data(spark, n=3000, seed=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = 0 if i % 3 == 0 else rnd.randint(1, 40)  # key 0 holds a third of the rows
        rows.append((i, key, rnd.randint(0, 500), rnd.randint(-5, 9)))
    return spark.createDataFrame(rows, "id long, k long, t long, v long")


def test_running_sums(spark):
    df = _data(spark)
    got = running_sums(df, ["k"], ["t", "id"], {"s": F.col("v")}, F.floor(F.col("t") / 50))
    w = Window.partitionBy("k").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, -1)
    exp = df.withColumn("s", F.coalesce(F.sum("v").over(w), F.lit(0)))
    assert got.select("id", "s").exceptAll(exp.select("id", "s")).count() == 0
    assert got.count() == df.count()
    inc = running_sums(df, ["k"], ["t", "id"], {"s": F.col("v")}, F.floor(F.col("t") / 50), inclusive=True)
    w2 = Window.partitionBy("k").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
    exp2 = df.withColumn("s", F.sum("v").over(w2))
    assert inc.select("id", "s").exceptAll(exp2.select("id", "s")).count() == 0


def test_previous_value(spark):
    df = _data(spark)
    got = previous_value(df, ["k"], ["t", "id"], "t", "prev", F.floor(F.col("t") / 50))
    exp = df.withColumn("prev", F.lag("t").over(Window.partitionBy("k").orderBy("t", "id")))
    assert got.select("id", "prev").exceptAll(exp.select("id", "prev")).count() == 0


def test_rank_within_limit(spark):
    df = _data(spark).withColumn("lim", F.when(F.col("k") == 3, None).otherwise(F.col("k") + 2))
    got = rank_within_limit(df, ["k"], ["t", "id"], F.col("lim"), F.floor(F.col("t") / 50), out="ok")
    rn = F.row_number().over(Window.partitionBy("k").orderBy("t", "id"))
    exp = df.withColumn("ok", F.col("lim").isNull() | (rn <= F.col("lim")))
    assert got.select("id", "ok").exceptAll(exp.select("id", "ok")).count() == 0


def test_range_and_auto_modes_equal_plain_windows(spark):
    """RANGE buckets (range-partition index) and the auto mode, forced to
    split by a low ``hot_rows``, give the plain per-key results."""
    df = _data(spark)
    w = Window.partitionBy("k").orderBy("t", "id")
    exp = (
        df.withColumn("s", F.coalesce(F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("prev", F.lag("t").over(w))
        .withColumn("ok", F.row_number().over(w) <= F.col("k") + 2)
    )
    for mode, hot in ((RANGE, HOT_KEY_ROWS), (PLAIN, 10), (None, 10), (None, HOT_KEY_ROWS)):
        s = running_sums(df, ["k"], ["t", "id"], {"s": F.col("v")}, mode, hot_rows=hot)
        assert s.select("id", "s").exceptAll(exp.select("id", "s")).count() == 0
        p = previous_value(df, ["k"], ["t", "id"], "t", "prev", mode, hot_rows=hot)
        assert p.select("id", "prev").exceptAll(exp.select("id", "prev")).count() == 0
        r = rank_within_limit(df, ["k"], ["t", "id"], F.col("k") + 2, mode, out="ok", hot_rows=hot)
        assert r.select("id", "ok").exceptAll(exp.select("id", "ok")).count() == 0
        assert s.count() == p.count() == r.count() == df.count()


def test_range_buckets_spread_a_hot_key(spark):
    df = _data(spark)  # key 0 holds 1000 of 3000 rows
    b = range_buckets(df, ["k"], ["t", "id"])
    sizes = b.filter("k = 0").groupBy("__bucket").count().collect()
    assert len(sizes) >= 2
    assert max(r["count"] for r in sizes) < 1000
    # order-preserving: along key 0's order the bucket never decreases
    rows = b.filter("k = 0").orderBy("t", "id").select("__bucket").collect()
    seq = [r[0] for r in rows]
    assert seq == sorted(seq)


def test_bucket_mode_follows_the_largest_key(spark):
    df = _data(spark)  # key 0 holds 1000 rows
    assert bucket_mode(df, ["k"], hot_rows=999) == RANGE
    assert bucket_mode(df, ["k"], hot_rows=1000) == PLAIN


@pytest.mark.parametrize("bucket", [PLAIN, RANGE])
def test_rank_descending_with_ties_and_nulls(spark, bucket):
    draw = random.Random(2)
    rows = [("hot", draw.choice([None, *range(12)]), k) for k in range(300)] + [("cold", 5, 1), ("cold", None, 2), (None, 3, 3), (None, 4, 4)]
    df = spark.createDataFrame(rows, "k string, v int, id int").repartition(5)
    got = {(r["k"], r["v"], r["id"], r["r"]) for r in rank_descending(df, ["k"], "v", "r", bucket).collect()}

    def rank(k, v):
        return 1 + sum(o == k and (w is not None if v is None else w is not None and w > v) for o, w, _ in rows)

    assert got == {(k, v, i, rank(k, v)) for k, v, i in rows}

"""Connected components by alternating large-star and small-star.

Large-star: every node sends its larger neighbours to the smallest node of
its neighbourhood. Small-star: every node sends itself and its smaller
neighbours there. Both keep the components, and alternating them ends in
stars whose centres are the smallest nodes. No node's neighbourhood is ever
collected: its minimum is an aggregate with partial sums, and the links meet
it in a join that Spark can split where a node has very many of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from stockroom.session import cut_lineage, lineage_scope


def _neighbours(links: DataFrame) -> DataFrame:
    return links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _least(pairs: DataFrame) -> DataFrame:
    """(a, least): the smallest of a and its partners."""
    found = pairs.groupBy("a").agg(F.min("b").alias("least"))
    return cut_lineage(found.select("a", F.least("a", "least").alias("least")), "star-least")


def large_star(links: DataFrame) -> DataFrame:
    """(a, b), a > b -> the links (larger neighbour, smallest of the neighbourhood)."""
    both = _neighbours(links)
    moved = both.join(_least(both), "a").filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return cut_lineage(moved.distinct(), "large-star")


def small_star(links: DataFrame, mark: Observation | None = None) -> DataFrame:
    """(a, b), a > b -> the links of a and its smaller neighbours to the smallest."""
    least = _least(links)
    moved = links.join(least, "a").filter("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    moved = moved.union(least.select("a", F.col("least").alias("b"))).distinct()
    return cut_lineage(moved if mark is None else moved.observe(mark, *_digest()), "small-star")


def _digest() -> tuple[Column, Column]:
    """Tells whether two link tables are the same; taken while a table is written."""
    return F.count(F.lit(1)).alias("links"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("marks")


def components(links: DataFrame) -> DataFrame:
    """Links (a, b) of two longs -> (node, label), one row per linked node;
    the label is the component's smallest node. Repeated links and links of a
    node with itself are allowed; no links give an empty result. The rounds'
    tables go when the result is written."""
    with lineage_scope(links.sparkSession):
        return cut_lineage(_starred(links), "star-labels", outlives=True)


def _starred(links: DataFrame) -> DataFrame:
    ordered = links.select(F.greatest("a", "b").cast("long").alias("a"), F.least("a", "b").cast("long").alias("b"))
    mark = Observation("star-links")
    stars = cut_lineage(ordered.filter("a <> b").distinct().observe(mark, *_digest()), "star-links")
    before, now = None, mark.get
    while before != now and now["links"]:
        mark = Observation("stars")
        stars = small_star(large_star(stars), mark)
        before, now = now, mark.get
    centres = stars.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("label"))
    return stars.select(F.col("a").alias("node"), F.col("b").alias("label")).union(centres)

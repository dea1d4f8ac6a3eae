"""Connected components of a link table by hooking and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockroom.session import cut_lineage, lineage_scope


def components(links: DataFrame) -> DataFrame:
    """Links (a, b) of two longs -> (node, label), one row per linked node.

    Each round every node hooks to its smallest neighbour (or itself), two
    pointer jumps follow, and the links are rewritten to the labels; links
    within a label go. A component loses at least half of its labels in a
    round, so the rounds grow with the logarithm of its size, whatever its
    shape. Each round is written, so a lost executor repeats one round; the
    rounds' tables go when the result is written. An empty link table gives
    an empty result; repeated links and links of a node with itself are
    allowed.
    """
    with lineage_scope(links.sparkSession):
        return cut_lineage(_contracted(links), "component-labels", outlives=True)


def _contracted(links: DataFrame) -> DataFrame:
    links = cut_lineage(links.select(F.col("a").cast("long"), F.col("b").cast("long")).filter("a <> b").distinct(), "links")
    labels = cut_lineage(
        links.select(F.col("a").alias("node")).union(links.select("b")).distinct().withColumn("label", F.col("node")), "labels"
    )
    while not links.isEmpty():
        both = links.union(links.select("b", "a"))
        hooks = cut_lineage(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("up")), "hooks")
        for _ in range(2):
            jump = hooks.select(F.col("a").alias("up"), F.col("up").alias("next"))
            hooks = hooks.join(jump, "up", "left").select("a", F.coalesce("next", "up").alias("up"))
        hooks = cut_lineage(hooks, "hooks")
        to = hooks.select(F.col("a").alias("label"), "up")
        labels = cut_lineage(labels.join(to, "label", "left").select("node", F.coalesce("up", "label").alias("label")), "labels")
        links = links.join(hooks, "a").select(F.col("up").alias("c"), "b").join(
            hooks.select(F.col("a").alias("b"), F.col("up").alias("d")), "b"
        )
        links = cut_lineage(links.select(F.least("c", "d").alias("a"), F.greatest("c", "d").alias("b")).filter("a <> b").distinct(), "links")
    return labels

"""Mixing sources to target weights without sorting documents.

Every source gets a budget of words. A budget above the source's size is
met by whole passes over the source plus one partial pass; the partial pass
takes the documents whose hash lies under the source's threshold. Larger
budgets have larger thresholds, so the mixes of growing budgets are nested.

The threshold comes from histograms: words by (source, hash bucket), the
bucket in which the budget is reached, then the same again inside that
bucket only, ``LEVELS`` times, until one hash value is left. Documents are
never sorted and the hot source is pre-aggregated before each shuffle; a
histogram has at most ``2 ** LEVEL_BITS`` rows a source.

Defined results
    null text has size 0; a null source is a source of its own, the last in
    order; rows with equal keys share a hash and are taken together or not
    at all; a source of size 0 has target 0; an empty table gives an empty
    result. The last hash value is taken when that brings the source nearer
    to its budget. Extra columns are kept as they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockroom.functions.joins import broadcast_if_small
from stockroom.llm.words import word_count
from stockroom.session import cut_lineage

WEIGHTS = (5, 2, 1)
CAP = 3
LEVEL_BITS = 12
LEVELS = 5  # 60 hash bits


def key_hash(key: Column, seed: str = "mix") -> Column:
    """60 bits of MD5 over the key as text (null: empty)."""
    text = F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, source_size) -> the same plus target.

    All words are shared by weight. A source stops at ``cap`` times its size
    and its excess goes to the others by weight. In order of cap / weight
    the capped sources come first, so running sums over the sources (one row
    each) find the share of a unit of weight in one pass.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    n = len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(by_name) - 1) % n + 1).cast("long")
    rows = sizes.withColumn("weight", weight).withColumn("most", F.col("source_size") * cap)
    order = (F.col("most").cast("double") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumns({
        "words_left": F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0)),
        "weight_left": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)),
    })
    rows = rows.withColumn("capped", F.col("words_left") * F.col("weight") > F.col("most") * F.col("weight_left"))
    share = F.struct("weight_left", "words_left")
    # the first source that is not capped has the largest weight left
    rows = rows.withColumn("free", F.max(F.when(~F.col("capped"), share)).over(everything))
    target = F.when(F.col("capped"), F.col("most").cast("double")).otherwise(
        (F.col("free.words_left") * F.col("weight")).cast("double") / F.col("free.weight_left")
    )
    return rows.select("source", "source_size", target.alias("target"))


def thresholds(sized: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, size, h) of every document -> one row per source: target,
    whole passes and the highest hash taken in the partial pass."""
    sources = source_targets(
        sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, cap
    )
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    sources = cut_lineage(sources.withColumn("passes", passes.cast("long")), "mix-sources")
    left = F.col("target") - F.col("passes") * F.col("source_size")
    state = sources.select("source", left.alias("left"), F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("below"))
    inside = sized
    for level in range(LEVELS):
        shift = LEVEL_BITS * (LEVELS - 1 - level)
        bucket = F.shiftright("h", shift)
        if level:  # only the bucket in which the budget is reached
            at = broadcast_if_small(state.select(F.col("source").alias("at"), "prefix"))
            inside = inside.join(
                at, F.col("source").eqNullSafe(F.col("at")) & (F.shiftright("h", shift + LEVEL_BITS) == F.col("prefix"))
            ).drop("at", "prefix")
        counts = inside.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("words"))
        counts = counts.join(
            broadcast_if_small(state.select(F.col("source").alias("at"), "left", "below")), F.col("source").eqNullSafe(F.col("at"))
        )
        upto = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
        counts = counts.withColumn("through", F.col("below") + F.sum("words").over(upto))
        reached = F.when(F.col("through") >= F.col("left"), F.struct("bucket", "words", "through"))
        state = cut_lineage(
            counts.groupBy("source").agg(
                F.min("left").alias("left"), F.min(reached).alias("at"), F.max(F.struct("bucket", "words", "through")).alias("top")
            ).withColumn("at", F.coalesce("at", "top")).select(
                "source", "left", F.col("at.bucket").alias("prefix"), (F.col("at.through") - F.col("at.words")).alias("below"),
                F.col("at.through").alias("through"),
            ),
            f"mix-level{level}",
        )
    last = F.when(F.col("below") + F.col("through") < 2 * F.col("left"), F.col("prefix")).otherwise(F.col("prefix") - 1)
    state = state.select(F.col("source").alias("at"), last.alias("highest"))
    return cut_lineage(sources.join(state, F.col("source").eqNullSafe(F.col("at"))).drop("at"), "mix-thresholds")


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
        weights: Sequence[int] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """One row per document: key, size, source_size, target, copies, taken.

    ``copies`` says how often the mix holds the document and ``taken`` how
    many words that makes."""
    sized = cut_lineage(
        docs.select(F.col(key).alias("key"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"),
                    key_hash(F.col(key)).alias("h")),
        "mix-sizes",
    )
    at = thresholds(sized, weights, cap).withColumnRenamed("source", "at")
    copies = F.col("passes") + (F.col("h") <= F.col("highest")).cast("long")
    out = sized.join(broadcast_if_small(at), F.col("source").eqNullSafe(F.col("at"))).withColumn("copies", copies)
    return out.select(
        F.col("key").alias(key), "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken")
    )


def mixed_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
                    weights: Sequence[int] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """The documents of the mix with the columns of ``docs``; a document
    that the mix holds several times is repeated."""
    sized = cut_lineage(
        docs.select(F.col(source).alias("source"), word_count(F.col(text)).alias("size"), key_hash(F.col(key)).alias("h")),
        "mix-sizes",
    )
    at = thresholds(sized, weights, cap).select(F.struct("source", "passes", "highest").alias("__mix"))
    joined = docs.join(broadcast_if_small(at), docs[source].eqNullSafe(F.col("__mix.source")))
    copies = F.col("__mix.passes") + (key_hash(docs[key]) <= F.col("__mix.highest")).cast("long")
    repeated = joined.withColumn("__copy", F.explode(F.array_repeat(F.lit(0), copies.cast("int"))))
    return repeated.drop("__mix", "__copy")

"""All-or-nothing stock allocation in arrival order, at scale.

Serial rule (the reference, one order at a time): an order is accepted when
every line fits the stock left after all *earlier accepted* orders;
otherwise it is rejected and takes nothing. A plain running sum is wrong,
because a rejected order must not consume stock.

Parallel form: every line carries its order's decision d in {NULL, true,
false}. Per product, in arrival order, over strictly earlier lines:

    ub = demand of lines whose d is not false   (upper bound of true use)
    lb = demand of lines whose d is true        (lower bound of true use)

An undecided order is *accepted* if all its lines fit ``stock - ub`` and
*rejected* if any line misses ``stock - lb``. True earlier use lies between
lb and ub, so each decision equals the serial one and never changes. The
earliest undecided order has lb = ub and is always decided, so the loop
ends; in practice within a few rounds.

Orders of one line each do not depend on each other across products: one
ordered pass per product decides them (``one_line``), however long the chain.

Each round is a running sum per product and a verdict per order; the loop
runs until every order is decided, whatever the size. Two rounds are one
written stage. If any product holds more than ``HOT_PRODUCT_LINES`` lines
(checked once, up front), the running sums are two-level (product, range
bucket), so a hot product is spread over many bounded tasks; the result is
the same. Rejected lines leave the loop, and so do lines after the last
undecided line of their product and products with nothing undecided. Each
stage's state is written once to the shared checkpoint folder, which bounds
lineage and survives executor loss.
"""

from __future__ import annotations

import time
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockroom.functions.windows import RANGE, hottest_key_rows, running_sums
from stockroom.session import cut_lineage

ORDER = ["request_ts", "request_id"]


def _seq() -> Column:
    return F.struct(*[F.col(c) for c in ORDER])


# Above this many lines for one product, the running sums switch to the
# two-level (product, range bucket) form so a hot product is not one task.
HOT_PRODUCT_LINES = 1_000_000
ROUNDS_PER_STAGE = 2


def _sums(state: DataFrame, values: dict, two_level: bool) -> DataFrame:
    if two_level:
        return running_sums(state, ["product_id"], ORDER, values, RANGE)
    w = Window.partitionBy("product_id").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, -1)
    return state.select("*", *[F.coalesce(F.sum(v).over(w), F.lit(0)).alias(n) for n, v in values.items()])


def _round(state: DataFrame, two_level: bool) -> DataFrame:
    """``state`` with the verdicts of one round in ``d``."""
    d = F.col("d")
    sums = _sums(
        state,
        {"_ub": F.when(d.isNull() | d, F.col("quantity")), "_lb": F.when(d, F.col("quantity"))},
        two_level,
    )
    # all lines of an order carry the same d: a window over the order's lines
    # keeps the round one pass, where a grouped verdict joined back made two
    order = Window.partitionBy("request_id")
    short = F.bool_or(F.col("stock") - F.col("_lb") < F.col("quantity")).over(order)
    fits = F.bool_and(F.col("stock") - F.col("_ub") >= F.col("quantity")).over(order)
    verdict = F.when(short, F.lit(False)).when(fits, F.lit(True))
    return sums.withColumn("_new", verdict).withColumn("d", F.coalesce(d, F.col("_new"))).drop("_new", "_ub", "_lb")


def _one_pass(base: DataFrame) -> DataFrame:
    """Decisions on orders of one line each: the serial rule along each
    product's lines. The lines of a task come sorted and in batches; only the
    units taken from the current product are held."""

    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        product, used = None, 0
        for frame in frames:
            accepted = []
            for p, quantity, stock in zip(frame["product_id"].tolist(), frame["quantity"].tolist(), frame["stock"].tolist(), strict=True):
                if p != product:
                    product, used = p, 0
                fits = stock - used >= quantity
                used += quantity if fits else 0
                accepted.append(fits)
            yield pd.DataFrame({"request_id": frame["request_id"], "accepted": accepted})

    ordered = base.select("product_id", *ORDER, "quantity", "stock").repartition("product_id").sortWithinPartitions("product_id", *ORDER)
    out = T.StructType([base.schema["request_id"], T.StructField("accepted", T.BooleanType())])
    return ordered.select("request_id", "product_id", "quantity", "stock").mapInPandas(scan, out)


def allocate_lines(
    lines: DataFrame,
    inventory: DataFrame | None,
    stats: list | None = None,
    carry: tuple[str, ...] = (),
    hot_product_lines: int = HOT_PRODUCT_LINES,
    rounds_per_stage: int = ROUNDS_PER_STAGE,
    *,
    one_line: bool = False,
    decided: DataFrame | None = None,
) -> DataFrame:
    """Decide every line's order; return lines with ``accepted`` and
    ``available_before`` (stock left just before this order, after all
    earlier accepted orders).

    ``lines``: (request_id, request_ts, product_id, quantity), one row per
    (request, product) of requests that passed validation.
    ``inventory``: (product_id, quantity_available), or None if ``carry`` names
    a column ``stock`` of the lines: the stock with all that is known to have
    come in before the line. ``carry`` names extra
    columns of ``lines`` that skip the loop and come back on the result.
    ``stats`` collects the open and loop lines after each written stage.
    ``one_line`` says that orders should have one line each (checked here).
    ``decided``: (request_id, accepted) of the orders whose fate is known
    already; every other order is accepted, and no loop runs.
    """
    wanted = lines.select("request_id", "request_ts", "product_id", "quantity", *carry)
    if inventory is not None:
        wanted = wanted.join(inventory.select("product_id", F.col("quantity_available").alias("stock")), "product_id")
    base = cut_lineage(wanted, "alloc-base")
    # one size check decides whether any product is hot enough to need the
    # two-level running sums (partial aggregation: cheap even when skewed)
    two_level = hottest_key_rows(base, ["product_id"]) > hot_product_lines

    if decided is None:
        if one_line and not two_level and hottest_key_rows(base, ["request_id"]) <= 1:
            decided = _one_pass(base)
        else:
            decided = _rounds(base, two_level, rounds_per_stage, stats)
    final = base.join(decided, "request_id", "left").withColumn("accepted", F.coalesce("accepted", F.lit(True)))
    used = _sums(final, {"_used": F.when(F.col("accepted"), F.col("quantity"))}, two_level)
    return used.withColumn("available_before", (F.col("stock") - F.col("_used")).cast("long")).drop("_used")


def _rounds(base: DataFrame, two_level: bool, rounds_per_stage: int, stats: list | None) -> DataFrame:
    """Decisions on all orders, round by round."""
    d = F.col("d")
    state = base.select(
        "request_id", "request_ts", "product_id", "quantity", "stock",
        F.lit(None).cast("boolean").alias("d"), F.lit(True).alias("_open"),
    )
    stages: list[DataFrame] = []
    open_lines, clock = 1, time.perf_counter()
    while open_lines:
        decided = state
        for _ in range(rounds_per_stage):
            decided = _round(decided, two_level)
        # one write per stage: the state with its verdicts; the decisions are
        # read back from these files at the end. The loop sizes are observed
        # during that write (no second job).
        sizes = Observation(f"alloc-stage-{len(stages)}")
        decided = cut_lineage(
            decided.observe(
                sizes,
                F.count(F.when(d.isNull() | d, 1)).alias("loop_lines"),
                F.count(F.when(d.isNull(), 1)).alias("open_lines"),
            ),
            "alloc-stage",
        )
        stages.append(decided)
        open_lines = sizes.get["open_lines"]
        if stats is not None:
            stats.append({"stage": len(stages), "rounds": rounds_per_stage * len(stages), "open_lines": open_lines,
                          "loop_lines": sizes.get["loop_lines"], "two_level": two_level,
                          "sec": round(time.perf_counter() - clock, 2)})
            clock = time.perf_counter()
        # prune: rejected lines, lines after their product's last open line,
        # and products with nothing open no longer affect any decision
        kept = decided.filter(d.isNull() | d).withColumn("_open", d.isNull())
        last_open = kept.filter(d.isNull()).groupBy("product_id").agg(F.max(_seq()).alias("_last_open"))
        state = kept.join(last_open, "product_id").filter(_seq() <= F.col("_last_open")).drop("_last_open")

    decisions = base.limit(0).select("request_id", F.lit(None).cast("boolean").alias("accepted"))
    for part in stages:  # each order is decided in one stage, where its lines were open
        newly = part.filter(F.col("_open") & d.isNotNull()).select("request_id", F.col("d").alias("accepted"))
        decisions = decisions.unionByName(newly)
    return decisions.distinct()


def allocation_outcomes(allocated: DataFrame) -> DataFrame:
    """Per order: accepted, and for a rejected one the lowest short product
    with the quantity requested and the stock then available."""
    short = (F.col("accepted") == F.lit(False)) & (F.col("available_before") < F.col("quantity"))
    info = F.struct(
        F.col("product_id").alias("p"), F.col("quantity").alias("q"), F.col("available_before").alias("a")
    )
    return (
        allocated.groupBy("request_id")
        .agg(
            F.max("accepted").alias("accepted"),
            F.min(F.when(short, info)).alias("_s"),
        )
        .select(
            "request_id",
            "accepted",
            F.col("_s.p").alias("short_product_id"),
            F.col("_s.q").cast("int").alias("requested"),
            F.col("_s.a").cast("int").alias("available"),
        )
    )

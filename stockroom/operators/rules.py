"""Change-driven rules (A1-A4): the reference's triggers as batch diffs.

A trigger reacts to one row change; here a rule compares a before and an
after snapshot joined on the key, or walks an ordered movement ledger with a
two-level running sum.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockroom.functions.money import lit_dec
from stockroom.functions.clock import ts_lit
from stockroom.functions.windows import bucket_mode, running_sums
from stockroom.operators.allocate import allocate_lines
from stockroom.session import cut_lineage

# Alert bands as fractions of the reorder point.
CRITICAL_SHARE = "0.2"
WARNING_SHARE = "0.45"
TRACKED_CUSTOMER_FIELDS = ("full_name", "email", "phone", "shipping_address")


def alert_level(on_hand: Column, reorder_point: Column) -> Column:
    """CRITICAL <= 0.2 x rp < WARNING <= 0.45 x rp < INFO <= rp; else NULL."""
    return (
        F.when(on_hand <= reorder_point * lit_dec(CRITICAL_SHARE), F.lit("CRITICAL"))
        .when(on_hand <= reorder_point * lit_dec(WARNING_SHARE), F.lit("WARNING"))
        .when(on_hand <= reorder_point, F.lit("INFO"))
    )


def alert_message(name: Column, on_hand: Column, reorder_point: Column, level: Column) -> Column:
    return F.concat(
        name, F.lit(" stock is at "), on_hand.cast("string"), F.lit(" units (reorder point: "),
        reorder_point.cast("string"), F.lit("). Level: "), level,
    )


def low_stock_alerts(
    before: DataFrame, after: DataFrame, product: DataFrame, as_of: dt.datetime
) -> DataFrame:
    """A1 (batch): one alert per product whose on-hand level changed and
    is now at or below its reorder point."""
    b = before.select("product_id", F.col("quantity_on_hand").alias("_old"))
    a = after.select("product_id", "quantity_on_hand", "reorder_point")
    j = a.join(b, "product_id").filter(F.col("_old") != F.col("quantity_on_hand"))
    j = j.join(product.select("product_id", "product_name"), "product_id", "left")
    level = alert_level(F.col("quantity_on_hand"), F.col("reorder_point"))
    return j.filter(level.isNotNull()).select(
        "product_id",
        level.alias("alert_level"),
        F.col("quantity_on_hand").alias("current_quantity"),
        "reorder_point",
        alert_message(F.col("product_name"), F.col("quantity_on_hand"), F.col("reorder_point"), level)
        .alias("message"),
        ts_lit(as_of).alias("alert_date"),
        F.lit(False).alias("resolved"),
    )


def movement_levels(movements: DataFrame, inventory: DataFrame) -> DataFrame:
    """On-hand level after each ledger movement, per product in (ts, id)
    order: start level + inclusive running sum of changes (two-level with
    range buckets when one product is hot)."""
    m = movements.join(inventory.select("product_id", "quantity_on_hand", "reorder_point"), "product_id")
    run = running_sums(
        m, ["product_id"], ["ts", "event_id"], {"_cum": F.col("quantity_change")},
        bucket_mode(movements, ["product_id"]), inclusive=True,
    )
    return run.withColumn("level", (F.col("quantity_on_hand") + F.col("_cum")).cast("int")).drop("_cum")


def movement_alerts(movements: DataFrame, inventory: DataFrame, product: DataFrame) -> DataFrame:
    """A1 (ledger form): an alert for each movement that changes the level
    and leaves it at or below the reorder point."""
    lv = movement_levels(movements, inventory).join(
        product.select("product_id", "product_name"), "product_id", "left"
    )
    level = alert_level(F.col("level"), F.col("reorder_point"))
    return lv.filter((F.col("quantity_change") != 0) & level.isNotNull()).select(
        F.col("event_id").alias("alert_id"),
        "product_id",
        level.alias("alert_level"),
        F.col("level").alias("current_quantity"),
        "reorder_point",
        alert_message(F.col("product_name"), F.col("level"), F.col("reorder_point"), level).alias("message"),
        F.col("ts").alias("alert_date"),
    )


def _image(df: DataFrame, fields: Sequence[str]) -> Column:
    cols = [F.col(f) if f in df.columns else F.lit(None).cast("string").alias(f) for f in fields]
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})


def customer_change_audit(
    before: DataFrame,
    after: DataFrame,
    as_of: dt.datetime,
    user: str,
    ip_address: str = "",
    user_agent: str = "",
    tracked_only: bool = False,
) -> DataFrame:
    """A2: one audit row per customer whose row changed, with old and new
    JSON images of the tracked fields. By default any column change counts;
    ``tracked_only`` restricts it to the four tracked fields."""
    key = "customer_id"
    compare = [c for c in after.columns if c != key and c in before.columns]
    if tracked_only:
        compare = [c for c in compare if c in TRACKED_CUSTOMER_FIELDS]
    old = before.select(key, _image(before, TRACKED_CUSTOMER_FIELDS).alias("old_values"),
                        *[F.col(c).alias("_o_" + c) for c in compare])
    new = after.select(key, _image(after, TRACKED_CUSTOMER_FIELDS).alias("new_values"),
                       *[F.col(c).alias("_n_" + c) for c in compare])
    differs = F.lit(False)
    for c in compare:
        differs = differs | ~F.col("_o_" + c).eqNullSafe(F.col("_n_" + c))
    j = old.join(new, key).filter(differs)
    return j.select(
        F.col(key).alias("audit_id"),
        F.lit(user).alias("user_id"),
        F.lit("UPDATE").alias("action"),
        F.lit("customer").alias("table_name"),
        F.col(key).alias("record_id"),
        "old_values",
        "new_values",
        F.lit(ip_address).alias("ip_address"),
        F.lit(user_agent).alias("user_agent"),
        ts_lit(as_of).alias("occurred_at"),
    )


def product_review_count(product: DataFrame, new_order_items: DataFrame) -> DataFrame:
    """A3: review_count += number of new order lines per product."""
    counts = new_order_items.groupBy("product_id").agg(F.count(F.lit(1)).alias("_new"))
    prior = F.col("review_count") if "review_count" in product.columns else F.lit(0)
    return product.join(counts, "product_id", "left").select(
        "product_id", (prior + F.coalesce(F.col("_new"), F.lit(0))).cast("int").alias("review_count")
    )


def negative_inventory_violations(proposed: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Proposed updates that would make on-hand negative (CRITICAL)."""
    return proposed.filter(F.col("quantity_on_hand") < 0).select(
        F.col("product_id").alias("violation_id"),
        F.lit("NegativeInventoryPrevention").alias("rule_name"),
        F.concat(F.lit("Attempt to set negative inventory for product "), F.col("product_id").cast("string"))
        .alias("violation_description"),
        F.lit("Inventory").alias("entity_type"),
        F.col("product_id").alias("entity_id"),
        F.lit("CRITICAL").alias("severity"),
        ts_lit(as_of).alias("occurred_at"),
    )


def negative_inventory_guard(current: DataFrame, proposed: DataFrame) -> DataFrame:
    """The stock table after the guard: a refused update keeps the
    current row, every other update applies."""
    p = proposed.select("product_id", *[F.col(c).alias("_p_" + c) for c in proposed.columns if c != "product_id"])
    j = current.join(p, "product_id", "left")
    refused = F.col("_p_quantity_on_hand").isNull() | (F.col("_p_quantity_on_hand") < 0)
    cols = [c for c in current.columns if c != "product_id"]
    return j.select(
        "product_id",
        *[F.when(refused, F.col(c)).otherwise(F.col("_p_" + c)).alias(c) for c in cols],
    )


def guarded_updates(inventory: DataFrame, updates: DataFrame) -> DataFrame:
    """A4 over a sequence of updates (update_id, ts, product_id, quantity_change):
    an update that would make on-hand negative is refused and leaves it as it
    is, so that later ones meet the level without it. One row per update of a
    known product: applied, and the level behind it. The first levels must not
    be negative.

    Refusals depend on each other, so this is no running sum. What comes in is
    never refused and is known ahead; what goes out is decided by the
    allocation (O5), an order of one line each, with the stock and all that
    came in before as its limit: one ordered pass per product. A product with
    very many updates is spread over range buckets there, with the rounds of
    the loop, and in the running sums.
    """
    order = ["ts", "update_id"]
    rows = updates.join(inventory.select("product_id", "quantity_on_hand"), "product_id")
    mode = bucket_mode(updates, ["product_id"])
    change = F.col("quantity_change").cast("long")
    known = running_sums(rows, ["product_id"], order, {"_in": F.when(change > 0, change)}, mode)
    known = cut_lineage(known.withColumn("stock", F.col("quantity_on_hand") + F.col("_in")).drop("_in"), "guarded-updates")
    out = known.filter("quantity_change < 0").select(
        F.col("update_id").alias("request_id"), F.col("ts").alias("request_ts"), "product_id", (-change).alias("quantity"), "stock")
    decided = allocate_lines(out, None, carry=("stock",), one_line=True).select(F.col("request_id").alias("update_id"), "accepted")
    applied = known.drop("stock").join(decided, "update_id", "left").withColumn("applied", F.coalesce("accepted", F.lit(True)))
    level = running_sums(applied, ["product_id"], order, {"_sum": F.when(F.col("applied"), change)}, mode, inclusive=True)
    return level.select("update_id", "ts", "product_id", "applied", (F.col("quantity_on_hand") + F.col("_sum")).alias("level"))


def refused_updates(guarded: DataFrame) -> DataFrame:
    """A4a for a sequence: one CRITICAL violation per refused update, at its time."""
    return guarded.filter(~F.col("applied")).select(
        F.col("update_id").alias("violation_id"),
        F.lit("NegativeInventoryPrevention").alias("rule_name"),
        F.concat(F.lit("Attempt to set negative inventory for product "), F.col("product_id").cast("string"))
        .alias("violation_description"),
        F.lit("Inventory").alias("entity_type"),
        F.col("product_id").alias("entity_id"),
        F.lit("CRITICAL").alias("severity"),
        F.col("ts").alias("occurred_at"),
    )

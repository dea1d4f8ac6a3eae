"""Restock batches (R1-R6): the one-restock procedure over a table of restocks.

Restock row: (restock_id, product_id, quantity, batch_number, supplier_id,
unit_cost). ``restock_id`` orders the batch (arrival order) and keys every
output row, so reruns replace rather than duplicate.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockroom.functions.clock import ts_lit
from stockroom.functions.windows import bucket_mode, running_sums
from stockroom.operators.allocate import allocate_lines
from stockroom.session import cut_lineage

INT_MAX = 2**31 - 1
RULE_RANGE = 5


def validate_restocks(
    restocks: DataFrame, product: DataFrame, suppliers: DataFrame, inventory: DataFrame | None = None
) -> DataFrame:
    """First failing rule per restock.

    NULL quantity or cost passes the two positivity tests (as coded). With
    ``inventory``, a restock that would lift its product's level beyond INT,
    given the restocks accepted before it, is refused (``refused_by_range``).
    """
    checks = _row_checks(restocks, product, suppliers)
    if inventory is None:
        return checks
    passed = restocks.join(checks.filter(F.col("failed_rule").isNull()).select("restock_id"), "restock_id", "left_semi")
    refused = refused_by_range(passed, inventory)
    if refused is None:
        return checks
    j = checks.join(refused.withColumn("_refused", F.lit(True)), "restock_id", "left")
    return j.select(
        "restock_id",
        F.when(F.col("_refused"), RULE_RANGE).otherwise(F.col("failed_rule")).alias("failed_rule"),
        F.when(F.col("_refused"), F.lit("Restock quantity or stock level is out of range")).otherwise(F.col("message")).alias("message"),
    )


def refused_by_range(passed: DataFrame, inventory: DataFrame) -> DataFrame | None:
    """restock_id of the restocks that do not fit below the largest INT, in
    restock order: one that does not fit leaves the level as it is, so that a
    smaller one behind it may fit. None if all fit.

    One sum per product tells which products can run over at all. Only those
    enter the rounds of the allocation (O5), with the room up to INT as stock.
    """
    room = inventory.select("product_id", (F.lit(INT_MAX) - F.col("quantity_on_hand").cast("long")).alias("quantity_available"))
    asked = passed.groupBy("product_id").agg(F.sum("quantity").alias("_asked"))
    tight = asked.join(room, "product_id").filter(F.col("_asked") > F.col("quantity_available")).select("product_id")
    tight = cut_lineage(tight, "restock-tight")
    if tight.isEmpty():
        return None
    lines = passed.filter("quantity > 0").join(tight, "product_id", "left_semi").select(
        F.col("restock_id").alias("request_id"), F.col("restock_id").alias("request_ts"), "product_id", "quantity")
    decided = allocate_lines(lines, room.join(tight, "product_id", "left_semi"))
    return decided.filter(~F.col("accepted")).select(F.col("request_id").alias("restock_id"))


def _row_checks(restocks: DataFrame, product: DataFrame, suppliers: DataFrame) -> DataFrame:
    prod = product.filter(F.col("is_active")).select(F.col("product_id").alias("_p"), F.lit(True).alias("_p_ok"))
    sup = suppliers.filter(F.col("is_active")).select(F.col("supplier_id").alias("_s"), F.lit(True).alias("_s_ok"))
    j = restocks.join(prod, restocks.product_id == prod._p, "left").join(
        sup, restocks.supplier_id == sup._s, "left"
    )
    q, cost = F.col("quantity"), F.col("unit_cost")
    no_product = F.col("_p_ok").isNull()
    no_supplier = F.col("supplier_id").isNotNull() & F.col("_s_ok").isNull()
    rule = F.when(q <= 0, 1).when(cost <= 0, 2).when(no_product, 3).when(no_supplier, 4)
    message = (
        F.when(q <= 0, F.lit("Quantity must be greater than 0"))
        .when(cost <= 0, F.lit("Unit cost must be greater than 0"))
        .when(no_product, F.concat(F.lit("Product ID "), F.col("product_id").cast("string"),
                                   F.lit(" does not exist or is inactive")))
        .when(no_supplier, F.concat(F.lit("Supplier ID "), F.col("supplier_id").cast("string"),
                                    F.lit(" does not exist or is inactive")))
    )
    return j.select("restock_id", rule.alias("failed_rule"), message.alias("message"))


def valid_restocks(restocks: DataFrame, checks: DataFrame) -> DataFrame:
    ok = checks.filter(F.col("failed_rule").isNull()).select("restock_id")
    return restocks.join(ok, "restock_id", "left_semi")


def restock_batches(valid: DataFrame, as_of: dt.datetime) -> DataFrame:
    """R2: lot rows for restocks that carry a batch number, with the expiry
    date of the request (none if the requests have no such column)."""
    expires = F.col("expiration_date") if "expiration_date" in valid.columns else F.lit(None).cast("date")
    return valid.filter(F.col("batch_number").isNotNull()).select(
        F.col("restock_id").alias("batch_id"),
        "product_id",
        "batch_number",
        "supplier_id",
        F.col("quantity").alias("quantity_received"),
        F.col("quantity").alias("quantity_remaining"),
        "unit_cost",
        ts_lit(as_of).alias("received_date"),
        expires.alias("expiration_date"),
    )


def apply_restocks(inventory: DataFrame, valid: DataFrame, as_of: dt.date) -> DataFrame:
    """On hand += received quantity; restock date set (pre-aggregated)."""
    received = valid.groupBy("product_id").agg(F.sum("quantity").cast("int").alias("_received"))
    j = inventory.join(received, "product_id", "left")
    on_hand = (F.col("quantity_on_hand") + F.coalesce(F.col("_received"), F.lit(0))).cast("int")
    # every other column of the snapshot stays as it is
    return j.withColumns({
        "quantity_on_hand": on_hand,
        "quantity_available": (on_hand - F.col("quantity_reserved")).cast("int"),
        "last_restock_date": F.when(F.col("_received").isNotNull(), F.lit(as_of)).otherwise(F.col("last_restock_date")),
    }).drop("_received")


def restock_movements(
    valid: DataFrame, inventory: DataFrame, as_of: dt.datetime, user: str
) -> DataFrame:
    """One RESTOCK ledger row per valid restock with the on-hand level
    before and after it, in restock order (running sum per product; two-level
    with range buckets when one product is hot)."""
    base = valid.join(inventory.select("product_id", "quantity_on_hand"), "product_id")
    run = running_sums(
        base, ["product_id"], ["restock_id"], {"_earlier": F.col("quantity")},
        bucket_mode(valid, ["product_id"]),
    )
    prev = (F.col("quantity_on_hand") + F.col("_earlier")).cast("int")
    batch = F.when(F.col("batch_number").isNotNull(), F.col("restock_id"))
    return run.select(
        F.col("restock_id").alias("log_id"),
        "product_id",
        F.col("quantity").alias("quantity_change"),
        F.lit("RESTOCK").alias("transaction_type"),
        F.lit("PURCHASE").alias("transaction_subtype"),
        batch.alias("reference_id"),
        F.lit("inventory_batch").alias("reference_table"),
        batch.alias("batch_id"),
        prev.alias("previous_quantity"),
        (prev + F.col("quantity")).cast("int").alias("new_quantity"),
        F.lit(user).alias("performed_by"),
        F.concat(F.lit("Restocked "), F.col("quantity").cast("string"), F.lit(" units")).alias("notes"),
        ts_lit(as_of).alias("log_date"),
    )


def resolve_alerts(low_stock_alerts: DataFrame, valid: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Open alerts of restocked products become resolved.

    The first restock of a product (in restock order) resolves them, so its
    quantity is the one named in the note.
    """
    first = valid.groupBy("product_id").agg(F.min_by("quantity", "restock_id").alias("_first_qty"))
    j = low_stock_alerts.join(first, "product_id", "left")
    hit = ~F.col("resolved") & F.col("_first_qty").isNotNull()
    prior_at = F.col("resolved_at") if "resolved_at" in low_stock_alerts.columns else F.lit(None).cast("timestamp_ntz")
    prior_notes = (
        F.col("resolution_notes") if "resolution_notes" in low_stock_alerts.columns else F.lit(None).cast("string")
    )
    keep = [c for c in low_stock_alerts.columns if c not in ("resolved", "resolved_at", "resolution_notes")]
    return j.select(
        *keep,
        (F.col("resolved") | hit).alias("resolved"),
        F.when(hit, ts_lit(as_of)).otherwise(prior_at).alias("resolved_at"),
        F.when(
            hit, F.concat(F.lit("Resolved by restock of "), F.col("_first_qty").cast("string"), F.lit(" units"))
        ).otherwise(prior_notes).alias("resolution_notes"),
    )


def restock_results(restocks: DataFrame, checks: DataFrame, movements: DataFrame) -> DataFrame:
    """Per restock: status and message (with the new stock level)."""
    j = restocks.select("restock_id", "product_id", "quantity").join(checks, "restock_id").join(
        movements.select(F.col("log_id").alias("restock_id"), "new_quantity"), "restock_id", "left"
    )
    ok = F.col("failed_rule").isNull()
    msg = F.concat(
        F.lit("Successfully restocked "), F.col("quantity").cast("string"), F.lit(" units of product "),
        F.col("product_id").cast("string"), F.lit(". New stock level: "), F.col("new_quantity").cast("string"),
    )
    return j.select(
        "restock_id",
        F.when(ok, "SUCCESS").otherwise("ERROR").alias("status"),
        F.when(ok, msg).otherwise(F.col("message")).alias("message"),
    )

"""Return batches (T1-T9): the one-return procedure over a table of requests.

Return request row: (request_id, order_id, items_json, return_reason,
refund_method); items are [{"order_item_id", "quantity", "condition"}].
The return id is the request id; requests are applied in request order.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockroom.functions.money import dec, floor_tenth
from stockroom.functions.clock import ts_lit
from stockroom.functions.ids import line_id
from stockroom.functions.windows import bucket_mode, running_sums

ITEM_FIELDS = T.ArrayType(
    T.StructType(
        [
            T.StructField("order_item_id", T.StringType()),
            T.StructField("quantity", T.StringType()),
            T.StructField("condition", T.StringType()),
        ]
    )
)
# Fixed value: conditions that may go back on the shelf.
RESTOCK_CONDITIONS = ("new", "opened")
EXCLUDED = ("Cancelled", "Returned")
INT_MAX = 2**31 - 1


def parse_return_requests(
    requests: DataFrame, order_item: DataFrame, spread: tuple[str, ...] = ("order_id", "order_item_id"),
) -> DataFrame:
    """JSON items -> lines, kept only if the item belongs to the order.

    Two lines for the same item are summed first, so together they are
    compared with the bought quantity; the lowest condition counts. The JSON
    is parsed once. The lines are spread by order and item, which serves both
    the grouped sum that merges them and the join with the items. ``spread``:
    by order alone the lines of a request stay together, and inside
    ``joined_in_place`` items that are spread by order are not moved either.
    """
    items = requests.select("request_id", "order_id", F.inline(F.from_json("items_json", ITEM_FIELDS)))
    typed = items.select(
        "request_id", "order_id", F.col("order_item_id").try_cast("long").alias("order_item_id"),
        F.col("quantity").try_cast("long").alias("quantity"), F.col("condition").alias("conditions"),
    )
    valid = typed.filter(F.col("order_id").isNotNull() & F.col("order_item_id").isNotNull() & (F.col("quantity") > 0))
    # a quantity beyond INT is beyond anything that was bought
    total = F.least(F.coalesce(F.try_sum("quantity"), F.lit(INT_MAX)), F.lit(INT_MAX)).cast("int")
    summed = valid.repartition(*spread).groupBy("request_id", "order_id", "order_item_id").agg(
        total.alias("quantity_returned"), F.min("conditions").alias("conditions")
    )
    oi = order_item.select(
        F.col("order_item_id").alias("_item"), F.col("order_id").alias("_oid"), "product_id",
        F.col("quantity").alias("bought"), "unit_price",
    )
    same = (F.col("order_id") == F.col("_oid")) & (F.col("order_item_id") == F.col("_item"))
    return summed.join(oi, same).select(
        "order_item_id", "request_id", "order_id", "quantity_returned", "conditions", "product_id", "bought", "unit_price"
    )


def line_facts(lines: DataFrame) -> DataFrame:
    """Per request: line count, the lowest item returned beyond what was
    bought, and the raw refund. Validation (T2) and pricing (T3) both read
    this one aggregate, so the line table is shuffled once for both, a row
    for each request if the lines of a request lie together."""
    return lines.groupBy("request_id").agg(
        F.count(F.lit(1)).alias("_n"),
        F.min(F.when(F.col("quantity_returned") > F.col("bought"), F.col("order_item_id"))).alias("_over"),
        _refund().alias("_refund_raw"),
    )


def _refund() -> Column:
    return F.sum(F.col("quantity_returned") * F.col("unit_price"))


def validate_returns(requests: DataFrame, lines: DataFrame, orders: DataFrame) -> DataFrame:
    """First failing rule per request: order exists and may be returned;
    valid JSON; at least one item; no quantity of zero or less; no item
    returned beyond what was bought.

    NULL items are no items, not bad JSON. An accepted return marks its order
    Returned, so of several requests for one order that pass these rules the
    first (lowest id) is accepted and the others meet a returned order.
    """
    return checked_returns(requests, line_facts(lines), orders).drop("_refund_raw")


def checked_returns(requests: DataFrame, facts: DataFrame, orders: DataFrame) -> DataFrame:
    """T2 on the line facts; the raw refund comes along."""
    open_orders = orders.filter(~F.col("order_status").isin(*EXCLUDED)).select(
        F.col("order_id").alias("_o"), F.col("customer_id")
    )
    no_order = F.col("_o").isNull()
    bad_json = F.col("items_json").isNotNull() & F.try_parse_json(F.col("items_json")).isNull()
    some_not_positive = F.exists(
        F.coalesce(F.from_json("items_json", ITEM_FIELDS), F.array().cast(ITEM_FIELDS)),
        lambda it: F.coalesce(it["quantity"].try_cast("long") <= 0, F.lit(False)),
    )
    # judged before the joins: the JSON text itself need not be shuffled
    judged = requests.select("request_id", "order_id", bad_json.alias("_bad"), some_not_positive.alias("_not_positive"))
    # by request first: the rules and the first request of an order then need one shuffle by order
    j = judged.join(facts, "request_id", "left").join(open_orders, F.col("order_id") == F.col("_o"), "left")
    bad_json, not_positive = F.col("_bad"), F.col("_not_positive")
    no_items = F.coalesce(F.col("_n"), F.lit(0)) == 0
    over = F.col("_over").isNotNull()
    alone = F.when(no_order, 1).when(bad_json, 2).when(no_items, 3).when(not_positive, 5).when(over, 4)
    passes = j.withColumn("_alone", alone)
    first = F.min(F.when(F.col("_alone").isNull(), F.col("request_id"))).over(Window.partitionBy("order_id"))
    ranked = passes.withColumn("_first", first)
    beaten = F.col("_alone").isNull() & (F.col("request_id") > F.col("_first"))
    closed = F.concat(F.lit("Order ID "), F.col("order_id").cast("string"),
                      F.lit(" does not exist or cannot be returned"))
    message = (
        F.when(no_order | beaten, closed)
        .when(bad_json, F.lit("Invalid return items JSON"))
        .when(no_items, F.lit("No valid return items provided"))
        .when(not_positive, F.lit("Return quantity must be greater than 0"))
        .when(over, F.concat(F.lit("Cannot return more than originally purchased for item "),
                             F.col("_over").cast("string")))
    )
    return ranked.select(
        "request_id", "customer_id", F.when(beaten, 1).otherwise(F.col("_alone")).alias("failed_rule"),
        message.alias("message"), "_refund_raw",
    )


def price_returns(lines: DataFrame) -> DataFrame:
    """Restock eligibility per line and refund total per request."""
    eligible = F.lower(F.col("conditions")).isin(*RESTOCK_CONDITIONS)
    return lines.withColumn("restock_eligible", F.coalesce(eligible, F.lit(False)))


def refunds(priced_lines: DataFrame) -> DataFrame:
    return priced_lines.groupBy("request_id").agg(
        dec(_refund()).alias("refund_amount")
    )


def return_number(as_of: dt.datetime, return_id: Column) -> Column:
    return F.concat(F.lit("RET-" + as_of.strftime("%Y%m%d") + "-"), return_id.cast("string"))


def post_returns(accepted: DataFrame, refund: DataFrame | None, as_of: dt.datetime) -> DataFrame:
    """Return headers, status Requested, numbered RET-yyyyMMdd-id.
    ``refund``: per request; None where ``accepted`` has the refund_amount."""
    priced = accepted if refund is None else accepted.join(refund, "request_id")
    return priced.select(
        F.col("request_id").alias("return_id"),
        return_number(as_of, F.col("request_id")).alias("return_number"),
        "order_id",
        "customer_id",
        ts_lit(as_of).alias("return_date"),
        "return_reason",
        F.lit("Requested").alias("return_status"),
        "refund_amount",
        "refund_method",
    )


def post_return_items(accepted_lines: DataFrame) -> DataFrame:
    """T4b + T7: return lines with the restocked quantity set directly."""
    return accepted_lines.select(
        line_id("request_id", "order_item_id").alias("return_item_id"),
        F.col("request_id").alias("return_id"),
        "product_id",
        "order_item_id",
        "quantity_returned",
        "conditions",
        "restock_eligible",
        F.when(F.col("restock_eligible"), F.col("quantity_returned")).otherwise(F.lit(0)).cast("int")
        .alias("restocked_quantity"),
        F.col("unit_price").alias("unit_refund_amount"),
    )


def mark_orders_returned(orders: DataFrame, returns: DataFrame) -> DataFrame:
    """T5: orders with an accepted return become Returned (also partial ones)."""
    hit = returns.select(F.col("order_id").alias("_r")).distinct()
    j = orders.join(hit, orders.order_id == hit._r, "left")
    return j.withColumn(
        "order_status", F.when(F.col("_r").isNotNull(), F.lit("Returned")).otherwise(F.col("order_status"))
    ).drop("_r")


def _restocked(accepted_lines: DataFrame) -> DataFrame:
    return (
        accepted_lines.filter(F.col("restock_eligible"))
        .groupBy("request_id", "order_id", "product_id")
        .agg(F.sum("quantity_returned").cast("int").alias("total_returned"))
    )


def return_restock_movements(
    accepted_lines: DataFrame, inventory: DataFrame, as_of: dt.datetime, user: str, all_lines: DataFrame | None = None,
) -> DataFrame:
    """ADJUSTMENT/RETURN_RESTOCK ledger rows per (return, product), with
    the on-hand level before and after, in return order. ``all_lines``: a
    cheaper frame that holds at least the accepted lines, to bound a product."""
    per = _restocked(accepted_lines).join(inventory.select("product_id", "quantity_on_hand"), "product_id")
    run = running_sums(
        per, ["product_id"], ["request_id"], {"_earlier": F.col("total_returned")},
        bucket_mode(accepted_lines if all_lines is None else all_lines, ["product_id"]),
    )
    prev = (F.col("quantity_on_hand") + F.col("_earlier")).cast("int")
    return run.select(
        line_id("request_id", "product_id").alias("log_id"),
        "product_id",
        F.col("total_returned").alias("quantity_change"),
        F.lit("ADJUSTMENT").alias("transaction_type"),
        F.lit("RETURN_RESTOCK").alias("transaction_subtype"),
        F.col("request_id").alias("reference_id"),
        F.lit("returns").alias("reference_table"),
        prev.alias("previous_quantity"),
        (prev + F.col("total_returned")).cast("int").alias("new_quantity"),
        F.lit(user).alias("performed_by"),
        F.concat(F.lit("Return restock from order "), F.col("order_id").cast("string")).alias("notes"),
        ts_lit(as_of).alias("log_date"),
    )


def return_inventory(inventory: DataFrame, accepted_lines: DataFrame) -> DataFrame:
    """On hand += restock-eligible returned quantity."""
    back = _restocked(accepted_lines).groupBy("product_id").agg(F.sum("total_returned").alias("_back"))
    j = inventory.join(back, "product_id", "left")
    on_hand = (F.col("quantity_on_hand") + F.coalesce(F.col("_back"), F.lit(0))).cast("int")
    cols = [c for c in inventory.columns]
    return j.select(
        *[
            on_hand.alias(c) if c == "quantity_on_hand"
            else (on_hand - F.col("quantity_reserved")).cast("int").alias(c) if c == "quantity_available"
            else F.col(c)
            for c in cols
        ]
    )


def loyalty_clawback(posted: DataFrame, as_of: dt.datetime) -> DataFrame:
    """-floor(refund / 10) points per return with a positive refund."""
    return posted.filter(F.col("refund_amount") > 0).select(
        F.col("return_id").alias("transaction_id"),
        "customer_id",
        "return_id",
        (-floor_tenth(F.col("refund_amount"))).cast("int").alias("points_change"),
        F.lit("Adjusted").alias("transaction_type"),
        F.concat(F.lit("Points adjusted for return "), F.col("return_number")).alias("description"),
        ts_lit(as_of).alias("transaction_date"),
    )


def clawback_balances(customer_loyalty: DataFrame, clawback: DataFrame) -> DataFrame:
    """Points down, points_redeemed up, once per customer."""
    pts = clawback.groupBy("customer_id").agg((-F.sum("points_change")).cast("int").alias("_pts"))
    j = customer_loyalty.join(pts, "customer_id", "left")
    p = F.coalesce(F.col("_pts"), F.lit(0))
    redeemed = F.col("points_redeemed") if "points_redeemed" in customer_loyalty.columns else F.lit(0)
    # every other column of the snapshot stays as it is
    return j.withColumns({
        "loyalty_points": (F.col("loyalty_points") - p).cast("int"),
        "points_redeemed": (redeemed + p).cast("int"),
    }).drop("_pts")


def return_results(requests: DataFrame, checks: DataFrame, posted: DataFrame) -> DataFrame:
    """Per request: status, message with refund, return id and number."""
    j = requests.select("request_id").join(checks, "request_id").join(
        posted.select(F.col("return_id").alias("request_id"), "return_id", "return_number", "refund_amount"),
        "request_id", "left",
    )
    ok = F.col("failed_rule").isNull()
    msg = F.concat(
        F.lit("Return "), F.col("return_number"), F.lit(" processed successfully. Refund amount: $"),
        F.col("refund_amount").cast("string"),
    )
    return j.select(
        "request_id",
        F.when(ok, "SUCCESS").otherwise("ERROR").alias("status"),
        F.when(ok, msg).otherwise(F.col("message")).alias("message"),
        F.when(ok, F.col("return_id")).alias("return_id"),
        F.when(ok, F.col("return_number")).alias("return_number"),
    )

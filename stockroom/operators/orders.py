"""Order batches (O1-O4, O6-O13): the one-order procedure re-aimed at a table
of requests.

Request row: (request_id, request_ts, customer_id, items_json, payment_method,
shipping_method, shipping_address, promotion_code). ``request_ts`` is the
placement time (the reference's NOW()); (request_ts, request_id) is the
arrival order. Ids derive from request ids, so reruns are idempotent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockroom.functions.ids import LINES_PER_ID, MAX_PARENT_ID, line_id
from stockroom.functions.joins import broadcast_if_small
from stockroom.functions.money import at_most_int, dec, floor_tenth, lit_dec

ITEM_FIELDS = T.ArrayType(
    T.StructType(
        [T.StructField("product_id", T.StringType()), T.StructField("quantity", T.StringType())]
    )
)

# Fixed values of the pricing rules (must equal the reference).
TAX_RATE = "0.18"
SHIPPING_CHARGE = {"STANDARD": "5.00", "EXPRESS": "15.00", "OVERNIGHT": "25.00"}
SHIPPING_CHARGE_OTHER = "10.00"
DELIVERY_DAYS = {"STANDARD": 7, "EXPRESS": 3, "OVERNIGHT": 1}
DELIVERY_DAYS_OTHER = 5
POINTS_VALID_DAYS = 365

# Rule numbers, checked in this order; the first failing one is reported.
RULE_JSON, RULE_CUSTOMER, RULE_NO_ITEMS, RULE_MISSING, RULE_INACTIVE, RULE_NEGATIVE, RULE_STOCK, RULE_RANGE = range(1, 9)

INT_MAX = 2**31 - 1
MAX_AMOUNT = "99999999.99"  # DECIMAL(10,2)


def _items(col: str = "items_json") -> Column:
    return F.from_json(F.col(col), ITEM_FIELDS)


def parse_order_requests(requests: DataFrame) -> DataFrame:
    """O1: JSON array -> one line per (request, product), quantities summed.

    Fields are read as strings and cast leniently, so ``"2"`` counts as 2;
    lines with a NULL product or a quantity <= 0 are dropped. The JSON is
    parsed once; duplicates are merged by a grouped sum with map-side partial
    aggregation. A sum beyond INT becomes NULL and fails the range rule (O2),
    so that one such request cannot stop the batch.
    """
    items = requests.select("request_id", F.inline(_items()))
    typed = items.select(
        "request_id", F.col("product_id").try_cast("long").alias("product_id"),
        F.col("quantity").try_cast("long").alias("quantity"),
    )
    total = F.try_sum("quantity")
    return (
        typed.filter(F.col("product_id").isNotNull() & (F.col("quantity") > 0))
        .groupBy("request_id", "product_id")
        .agg(F.when(total <= INT_MAX, total).cast("int").alias("quantity"))
    )


def enrich_lines(lines: DataFrame, product: DataFrame, inventory: DataFrame) -> DataFrame:
    """Attach price, active flag and available stock to every line.

    A product without a stock row counts as missing (the reference joins
    product and inventory together).
    """
    dims = product.select("product_id", "price", "is_active", "product_name").join(
        inventory.select("product_id", F.col("quantity_available").alias("stock")), "product_id"
    )
    return lines.join(dims, "product_id", "left").withColumn("_known", F.col("price").isNotNull())


def request_facts(enriched: DataFrame) -> DataFrame:
    """Per request: line count, lowest missing and lowest inactive product,
    and the raw subtotal of its known lines.

    Validation (O2) and pricing (O3) both read this one aggregate, so the
    line table is shuffled once by request_id for both.
    """
    known = F.col("_known")
    return enriched.groupBy("request_id").agg(
        F.count(F.lit(1)).alias("_n_items"),
        F.min(F.when(~known, F.col("product_id"))).alias("_missing"),
        F.min(F.when(known & ~F.col("is_active"), F.col("product_id"))).alias("_inactive"),
        F.sum(F.when(known, F.col("quantity") * F.col("price"))).alias("_subtotal_raw"),
        F.bool_or(F.col("quantity").isNull()).alias("_huge"),
    )


def _out_of_range() -> Column:
    """A quantity beyond INT, a total beyond DECIMAL(10,2), or lines that
    have no ids (``functions.ids``). The total is that of the order without a
    promotion, computed wide: a promotion only lowers it, and may still be
    withdrawn."""
    subtotal = dec(F.col("_subtotal_raw"), 30)
    total = subtotal + dec(subtotal * lit_dec(TAX_RATE), 30) + shipping_charge(F.col("shipping_method"))
    return (
        F.coalesce(F.col("_huge"), F.lit(False))
        | F.coalesce(total > lit_dec(MAX_AMOUNT), F.lit(False))
        | F.coalesce(F.col("_n_items") > LINES_PER_ID, F.lit(False))
        | (F.abs("request_id") > MAX_PARENT_ID)
    )


def validated_requests(requests: DataFrame, facts: DataFrame, customer: DataFrame) -> DataFrame:
    """The request rows with their line facts, ``failed_rule`` and ``message``.

    Line facts arrive reduced to one row per request, so every join here is
    1:1 on the request (customer is a dimension lookup).
    """
    active = customer.filter(F.col("is_active")).select(
        F.col("customer_id").alias("_cust"), F.lit(True).alias("_cust_ok")
    )
    parsed = _items()
    # judged before the joins: the JSON text itself need not be shuffled
    parses = (
        F.col("items_json").isNotNull()
        & F.try_parse_json(F.col("items_json")).isNotNull()
        & (F.coalesce(F.size(parsed), F.lit(1)) != 0)
    )
    judged = requests.withColumn("_json_ok", parses)
    j = judged.join(active, judged.customer_id == active._cust, "left").join(facts, "request_id", "left")
    json_ok = F.col("_json_ok")
    rule = (
        F.when(~json_ok, RULE_JSON)
        .when(F.col("_cust_ok").isNull(), RULE_CUSTOMER)
        .when(F.coalesce(F.col("_n_items"), F.lit(0)) == 0, RULE_NO_ITEMS)
        .when(F.col("_missing").isNotNull(), RULE_MISSING)
        .when(F.col("_inactive").isNotNull(), RULE_INACTIVE)
        .when(_out_of_range(), RULE_RANGE)
    )
    message = (
        F.when(~json_ok, F.lit("Invalid or empty order items JSON"))
        .when(
            F.col("_cust_ok").isNull(),
            F.concat(F.lit("Customer ID "), F.col("customer_id").cast("string"),
                     F.lit(" does not exist or is inactive")),
        )
        .when(F.coalesce(F.col("_n_items"), F.lit(0)) == 0, F.lit("No valid order items provided"))
        .when(
            F.col("_missing").isNotNull(),
            F.concat(F.lit("Product ID "), F.col("_missing").cast("string"), F.lit(" does not exist")),
        )
        .when(
            F.col("_inactive").isNotNull(),
            F.concat(F.lit("Product ID "), F.col("_inactive").cast("string"), F.lit(" is inactive")),
        )
        .when(_out_of_range(), F.lit("Order quantity or amount is out of range"))
    )
    raw = F.when(_out_of_range(), F.lit(None)).otherwise(F.col("_subtotal_raw"))
    return j.withColumns({"failed_rule": rule, "message": message, "_subtotal_raw": raw}).drop(
        "_json_ok", "_cust", "_cust_ok", "_n_items", "_missing", "_inactive", "_huge"
    )


def validate_order_requests(
    requests: DataFrame, enriched: DataFrame, customer: DataFrame
) -> DataFrame:
    """O2: first failing rule per request (stock is O5)."""
    heads = requests.select("request_id", "customer_id", "items_json", "shipping_method")
    return validated_requests(heads, request_facts(enriched), customer).select(
        "request_id", "failed_rule", "message"
    )


def _amounts(subtotal: Column, shipping_method: Column) -> list[Column]:
    """O3's three amounts from a subtotal, each rounded to cents."""
    return [
        dec(subtotal).alias("subtotal"),
        dec(dec(subtotal) * lit_dec(TAX_RATE)).alias("tax_amount"),
        shipping_charge(shipping_method).alias("base_shipping"),
    ]


def price_orders(enriched: DataFrame, requests: DataFrame) -> DataFrame:
    """O3: subtotal, 18 % tax and shipping by method (case-insensitive).

    Each amount is rounded half up to cents on assignment, as DECIMAL(10,2).
    """
    sub = enriched.filter(F.col("_known")).groupBy("request_id").agg(
        F.sum(F.col("quantity") * F.col("price")).alias("_subtotal_raw")
    )
    heads = requests.select("request_id", "shipping_method")
    return sub.join(heads, "request_id").select(
        "request_id", *_amounts(F.col("_subtotal_raw"), F.col("shipping_method"))
    )


def shipping_charge(method: Column) -> Column:
    m = F.upper(method)
    expr = None
    for name, charge in SHIPPING_CHARGE.items():
        expr = (F.when if expr is None else expr.when)(m == name, lit_dec(charge))
    return dec(expr.otherwise(lit_dec(SHIPPING_CHARGE_OTHER)))


def delivery_days(method: Column) -> Column:
    m = F.upper(method)
    expr = None
    for name, days in DELIVERY_DAYS.items():
        expr = (F.when if expr is None else expr.when)(m == name, F.lit(days))
    return expr.otherwise(F.lit(DELIVERY_DAYS_OTHER))


PROMOTED = [
    "promotion_id", "promotion_type", "max_uses_total", "times_used",
    "promo_value", "discount_amount", "shipping_amount", "total_amount",
]


def promote(base: DataFrame, promotions: DataFrame) -> DataFrame:
    """O4 on a frame that carries request_ts, promotion_code, subtotal,
    tax_amount and base_shipping; every column of ``base`` is kept and the
    ``PROMOTED`` columns are added.

    Code match is case-insensitive; the promotion must be active, valid at
    the request time, have uses left and its minimum met. Percentage
    discounts are capped by ``maximum_discount_amount``; free shipping waives
    the charge once (no second subtraction as a discount). Codes are unique,
    so the dimension join adds at most one row per request.
    """
    keep = list(base.columns)
    base = base.withColumn("_code", F.lower("promotion_code"))
    # codes have few values: joined by key, one task would get every
    # request of the most common code, so the (size-checked) catalogue is
    # broadcast instead
    promo = broadcast_if_small(promotions).select(
        F.lower("promotion_code").alias("_code"),
        "promotion_id", "promotion_type", "discount_value", "minimum_order_amount",
        "maximum_discount_amount", "valid_from", "valid_to", "max_uses_total", "times_used",
        F.col("is_active").alias("_p_active"),
    )
    cond = (
        (base._code == promo._code)
        & promo._p_active
        & (promo.valid_from <= base.request_ts)
        & (promo.valid_to >= base.request_ts)
        & (promo.max_uses_total.isNull() | (promo.times_used < promo.max_uses_total))
        & ((base.subtotal >= promo.minimum_order_amount) | (promo.minimum_order_amount == 0))
    )
    j = base.join(promo, cond, "left").drop(promo._code).drop("_code", "_p_active")
    ptype = F.col("promotion_type")
    pct = dec(
        F.least(
            F.col("subtotal") * F.col("discount_value") * lit_dec("0.01"),
            F.coalesce(F.col("maximum_discount_amount"), F.col("subtotal")),
        )
    )
    discount = (
        F.when(ptype == "Percentage", pct)
        .when(ptype == "Fixed Amount", dec(F.col("discount_value")))
        .otherwise(dec(F.lit(0)))
    )
    free_ship = ptype == "Free Shipping"
    shipping = F.when(free_ship, dec(F.lit(0))).otherwise(F.col("base_shipping"))
    promo_value = F.when(free_ship, F.col("base_shipping")).otherwise(discount)
    return j.select(
        *keep,
        "promotion_id", "promotion_type", "max_uses_total", "times_used",
        dec(promo_value).alias("promo_value"),
        discount.alias("discount_amount"),
        dec(shipping).alias("shipping_amount"),
    ).withColumn(
        "total_amount",
        dec(F.col("subtotal") + F.col("tax_amount") + F.col("shipping_amount") - F.col("discount_amount")),
    )


def apply_promotions(priced: DataFrame, requests: DataFrame, promotions: DataFrame) -> DataFrame:
    """The candidate promotion of each priced request and its effect.

    Adds promotion_id, promotion_type, discount_amount, shipping_amount,
    total_amount, promo_value (what a usage row records), max_uses_total,
    times_used.
    """
    req = requests.select("request_id", "request_ts", "promotion_code")
    out = promote(priced.join(req, "request_id"), promotions)
    return out.select("request_id", "subtotal", "tax_amount", "base_shipping", *PROMOTED)


def evaluate_requests(validated: DataFrame, promotions: DataFrame) -> DataFrame:
    """O3 and O4 on the validated request frame (``validated_requests``).

    Amounts are computed from the request's own line facts, so pricing
    takes no second pass over the lines; requests that failed O2 keep NULL
    amounts and no promotion.
    """
    passed = F.col("failed_rule").isNull()
    priced = validated.select(
        "*", *_amounts(F.when(passed, F.col("_subtotal_raw")), F.col("shipping_method"))
    ).drop("_subtotal_raw")
    out = promote(priced, promotions)
    return out.withColumns({c: F.when(passed, F.col(c)) for c in ["base_shipping", *PROMOTED]})


def without_promotion(df: DataFrame) -> DataFrame:
    """Reprice rows whose promotion was not granted (cap reached)."""
    return df.withColumns(
        {
            "promotion_id": F.lit(None).cast("int"),
            "promotion_type": F.lit(None).cast("string"),
            "promo_value": dec(F.lit(0)),
            "discount_amount": dec(F.lit(0)),
            "shipping_amount": F.col("base_shipping"),
            "total_amount": dec(F.col("subtotal") + F.col("tax_amount") + F.col("base_shipping")),
        }
    )


def order_number(prefix: str, ts: Column, request_id: Column) -> Column:
    return F.concat(F.lit(prefix + "-"), F.date_format(ts, "yyyyMMdd"), F.lit("-"), request_id.cast("string"))


def post_orders(accepted: DataFrame) -> DataFrame:
    """Order headers of accepted requests, status Pending."""
    return accepted.select(
        F.col("request_id").alias("order_id"),
        order_number("ORD", F.col("request_ts"), F.col("request_id")).alias("order_number"),
        "customer_id",
        F.col("request_ts").alias("order_date"),
        "subtotal", "tax_amount", "shipping_amount", "discount_amount", "total_amount",
        F.lit("Pending").alias("order_status"),
        F.lit("Pending").alias("payment_status"),
        "payment_method",
        "shipping_method",
    )


def line_ids(lines: DataFrame) -> DataFrame:
    """order_item_id: request id and position of the product in the request."""
    return lines.withColumn("order_item_id", line_id("request_id", "product_id"))


def post_order_items(accepted_lines: DataFrame) -> DataFrame:
    """Order lines of accepted requests at the product price."""
    return accepted_lines.select(
        "order_item_id",
        F.col("request_id").alias("order_id"),
        "product_id",
        "quantity",
        F.col("price").alias("unit_price"),
    )


def reserve_inventory(inventory: DataFrame, accepted_lines: DataFrame) -> DataFrame:
    """Reserved += accepted quantity; last_sale_date = latest sale.

    Demand is summed per product before the update join (no fan-out).
    """
    demand = accepted_lines.groupBy("product_id").agg(
        F.sum("quantity").cast("int").alias("_demand"), F.max("request_ts").alias("_last_sale")
    )
    j = inventory.join(demand, "product_id", "left")
    reserved = (F.col("quantity_reserved") + F.coalesce(F.col("_demand"), F.lit(0))).cast("int")
    prior_sale = F.col("last_sale_date") if "last_sale_date" in inventory.columns else F.lit(None).cast("timestamp_ntz")
    return j.select(
        "product_id",
        "quantity_on_hand",
        reserved.alias("quantity_reserved"),
        (F.col("quantity_on_hand") - reserved).cast("int").alias("quantity_available"),
        "reorder_point",
        "reorder_quantity",
        "last_restock_date",
        F.coalesce(F.col("_last_sale"), prior_sale).alias("last_sale_date"),
    )


def order_movements(accepted_lines: DataFrame) -> DataFrame:
    """One ledger row per accepted line.

    previous/new quantity are the *available* stock just before and after
    this order in arrival order (``available_before`` comes from O5's final
    running sum), not the post-reservation snapshot the reference reads.
    """
    return accepted_lines.select(
        F.col("order_item_id").alias("log_id"),
        "product_id",
        (-F.col("quantity")).cast("int").alias("quantity_change"),
        F.lit("ORDER").alias("transaction_type"),
        F.lit(None).cast("string").alias("transaction_subtype"),
        F.col("request_id").alias("reference_id"),
        F.lit("orders").alias("reference_table"),
        F.col("available_before").cast("int").alias("previous_quantity"),
        (F.col("available_before") - F.col("quantity")).cast("int").alias("new_quantity"),
        F.concat(F.lit("Customer:"), F.col("customer_id").cast("string")).alias("performed_by"),
        F.col("request_ts").alias("log_date"),
    )


def promotion_usage(accepted: DataFrame) -> DataFrame:
    """Usage rows of granted promotions."""
    return accepted.filter(F.col("promotion_id").isNotNull()).select(
        F.col("request_id").alias("usage_id"),
        "promotion_id",
        "customer_id",
        F.col("request_id").alias("order_id"),
        F.col("request_ts").alias("used_at"),
        F.col("promo_value").alias("discount_applied"),
    )


def promotion_times_used(promotions: DataFrame, usage: DataFrame) -> DataFrame:
    """Promotions with times_used raised by this batch."""
    counts = usage.groupBy("promotion_id").agg(F.count(F.lit(1)).alias("_uses"))
    return promotions.join(counts, "promotion_id", "left").withColumn(
        "times_used", (F.col("times_used") + F.coalesce(F.col("_uses"), F.lit(0))).cast("int")
    ).drop("_uses")


def shipping_plan(accepted: DataFrame) -> DataFrame:
    """Shipping rows; delivery estimate 7/3/1/5 days by method."""
    return accepted.select(
        F.col("request_id").alias("shipping_id"),
        F.col("request_id").alias("order_id"),
        "shipping_method",
        F.col("shipping_amount").alias("shipping_cost"),
        "shipping_address",
        (F.col("request_ts") + F.make_dt_interval(days=delivery_days(F.col("shipping_method"))))
        .alias("estimated_delivery_date"),
    )


def loyalty_accrual(accepted: DataFrame) -> DataFrame:
    """floor(total / 10) points for every accepted order with total > 0."""
    paid = accepted.filter(F.col("total_amount") > 0)
    number = order_number("ORD", F.col("request_ts"), F.col("request_id"))
    return paid.select(
        F.col("request_id").alias("transaction_id"),
        "customer_id",
        F.col("request_id").alias("order_id"),
        floor_tenth(F.col("total_amount")).alias("points_change"),
        F.lit("Earned").alias("transaction_type"),
        F.concat(F.lit("Points earned for order "), number).alias("description"),
        F.col("request_ts").alias("transaction_date"),
        (F.col("request_ts") + F.make_dt_interval(days=F.lit(POINTS_VALID_DAYS))).alias("expiry_date"),
    )


def loyalty_balances(customer_loyalty: DataFrame, accrual: DataFrame, accepted: DataFrame) -> DataFrame:
    """Points and spend added once per customer (pre-aggregated). A
    balance stops at the largest value that its column holds; the ledger
    (O11a) keeps every change."""
    pts = accrual.groupBy("customer_id").agg(F.sum("points_change").alias("_pts"))
    spend = (
        accepted.filter(F.col("total_amount") > 0)
        .groupBy("customer_id")
        .agg(F.sum("total_amount").alias("_spend"))
    )
    cl = customer_loyalty
    earned = F.col("points_earned") if "points_earned" in cl.columns else F.lit(0)
    j = cl.join(pts, "customer_id", "left").join(spend, "customer_id", "left")
    p = F.coalesce(F.col("_pts"), F.lit(0))
    # every other column of the snapshot stays as it is
    return j.withColumns({
        "loyalty_points": at_most_int(F.col("loyalty_points") + p),
        "points_earned": at_most_int(earned + p),
        "total_spent": dec(F.least(F.col("total_spent") + F.coalesce(F.col("_spend"), F.lit(0)), lit_dec("9999999999.99")), 12),
    }).drop("_pts", "_spend")


def order_results(decided: DataFrame) -> DataFrame:
    """One row per request: status, message, ids and amounts."""
    ok = F.col("failed_rule").isNull()
    number = order_number("ORD", F.col("request_ts"), F.col("request_id"))
    amt = lambda c: F.when(ok, F.col(c))
    return decided.select(
        "request_id",
        F.when(ok, "SUCCESS").otherwise("ERROR").alias("status"),
        F.when(
            ok,
            F.concat(F.lit("Order "), number, F.lit(" placed successfully. Total: $"),
                     F.col("total_amount").cast("string")),
        ).otherwise(F.col("message")).alias("message"),
        F.when(ok, F.col("request_id")).alias("order_id"),
        F.when(ok, number).alias("order_number"),
        amt("subtotal").alias("subtotal"),
        amt("tax_amount").alias("tax"),
        amt("shipping_amount").alias("shipping"),
        amt("discount_amount").alias("discount"),
        amt("total_amount").alias("total"),
    )


def rejected_requests(decided: DataFrame) -> DataFrame:
    """Quarantine rows for rejected requests, parameters as JSON."""
    params = F.to_json(
        F.struct("customer_id", "payment_method", "shipping_method", "promotion_code"),
        {"ignoreNullFields": "false"},
    )
    return decided.filter(F.col("failed_rule").isNotNull()).select(
        F.col("request_id").alias("error_id"),
        F.lit("ORDER_PLACEMENT_ERROR").alias("error_code"),
        F.col("message").alias("error_message"),
        F.lit("PlaceOrder").alias("stored_procedure"),
        params.alias("parameters"),
        F.lit("HIGH").alias("severity"),
        F.col("request_ts").alias("created_at"),
    )

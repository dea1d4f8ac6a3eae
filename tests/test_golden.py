"""Golden cases worked out by hand from the seed rows (FIXTURES.md G1-G10)."""

import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

import seeds
from stockroom.operators import loyalty, orders, quality, restock, rules
from stockroom.plans.order_batch import order_batch

G1_ITEMS = '[{"product_id": 1, "quantity": 2}, {"product_id": 5, "quantity": 3}]'


def _batch(spark, rows):
    return order_batch(
        seeds.requests(spark, rows), seeds.customer(spark), seeds.product(spark),
        seeds.inventory(spark), seeds.promotions(spark),
    )


def _results(b):
    return {r["request_id"]: r for r in orders.order_results(b.decided).collect()}


def test_g1_g2_g3_g5_g8_order_batch(spark):
    b = _batch(spark, [
        (1, 0, 1, G1_ITEMS, "STANDARD", "EARLY15"),                      # G1
        (2, 1, 1, '[{"product_id": 1, "quantity": 700}]', "STANDARD", None),  # G2
        (3, 2, 1, '[{"product_id": 1, "quantity": 3}, {"product_id": 2, "quantity": 1}]', "EXPRESS", "early15"),  # G3
        (4, 3, 999999, '[{"product_id": 1, "quantity": 1}]', "STANDARD", None),  # G5
        (5, 4, 1, "[]", "STANDARD", None),                                   # G8
        (6, 5, 1, "nope", "STANDARD", None),
        (7, 6, 1, None, "STANDARD", None),
    ])
    res = _results(b)
    g1 = res[1]
    assert g1["status"] == "SUCCESS"
    assert (g1["subtotal"], g1["tax"], g1["shipping"], g1["discount"], g1["total"]) == (
        D("141.50"), D("25.47"), D("5.00"), D("21.23"), D("150.74"))
    assert g1["message"].endswith("placed successfully. Total: $150.74")
    assert res[2]["message"] == "Insufficient stock for Product ID 1. Requested: 700, Available: 42"
    g3 = res[3]
    assert (g3["subtotal"], g3["tax"], g3["shipping"], g3["discount"], g3["total"]) == (
        D("934.75"), D("168.26"), D("15.00"), D("90.00"), D("1028.01"))
    assert res[4]["message"] == "Customer ID 999999 does not exist or is inactive"
    for rid in (5, 6, 7):
        assert res[rid]["message"] == "Invalid or empty order items JSON"

    points = {r["order_id"]: r["points_change"] for r in orders.loyalty_accrual(b.accepted).collect()}
    assert points == {1: 15, 3: 102}
    inv = {r["product_id"]: r for r in orders.reserve_inventory(seeds.inventory(spark), b.accepted_lines).collect()}
    assert (inv[1]["quantity_on_hand"], inv[1]["quantity_reserved"]) == (44, 5)  # G1 2 + G3 3
    assert (inv[5]["quantity_on_hand"], inv[5]["quantity_reserved"]) == (170, 3)
    moves = orders.order_movements(b.accepted_lines).filter("product_id = 1").orderBy("log_date").collect()
    assert [(m["previous_quantity"], m["new_quantity"]) for m in moves] == [(44, 42), (42, 39)]
    quarantined = {r["error_id"] for r in orders.rejected_requests(b.decided).collect()}
    assert quarantined == {2, 4, 5, 6, 7}


def test_g9_duplicate_and_bad_lines(spark):
    items = ('[{"product_id": 1, "quantity": 2}, {"product_id": 1, "quantity": 3}, '
             '{"product_id": null, "quantity": 4}, {"product_id": 2, "quantity": 0}, '
             '{"product_id": "3", "quantity": "2"}]')
    req = seeds.requests(spark, [(1, 0, 1, items, "STANDARD", None)])
    lines = sorted((r["product_id"], r["quantity"]) for r in orders.parse_order_requests(req).collect())
    assert lines == [(1, 5), (3, 2)]


def test_free_shipping_waived_once(spark):
    b = _batch(spark, [(1, 0, 2, '[{"product_id": 3, "quantity": 1}]', "EXPRESS", "VANFREE")])
    r = _results(b)[1]
    assert (r["subtotal"], r["shipping"], r["discount"], r["total"]) == (
        D("92.00"), D("0.00"), D("0.00"), D("108.56"))
    usage = orders.promotion_usage(b.accepted).collect()
    assert usage[0]["discount_applied"] == D("15.00")


def test_g4_restock(spark):
    rs = spark.createDataFrame(
        [(1, 1, 100, "LOT-7", 1, D("10.00"))],
        "restock_id long, product_id long, quantity int, batch_number string, supplier_id long, unit_cost decimal(10,2)",
    )
    checks = restock.validate_restocks(rs, seeds.product(spark), seeds.suppliers(spark))
    valid = restock.valid_restocks(rs, checks)
    inv = seeds.inventory(spark)
    moves = restock.restock_movements(valid, inv, seeds.NOW, "tester")
    res = restock.restock_results(rs, checks, moves).collect()[0]
    assert res["status"] == "SUCCESS" and res["message"].endswith("New stock level: 144")
    m = moves.collect()[0]
    assert (m["previous_quantity"], m["new_quantity"]) == (44, 144)
    assert restock.restock_batches(valid, seeds.NOW).count() == 1
    after = restock.apply_restocks(inv, valid, seeds.NOW.date())
    assert rules.low_stock_alerts(inv, after, seeds.product(spark), seeds.NOW).count() == 0


def test_g6_delete_restricted(spark):
    cust = seeds.customer(spark)
    ords = spark.createDataFrame([(10, 1)], "order_id long, customer_id long")
    out = {r["customer_id"]: r["outcome"] for r in quality.delete_cascade_restrict(
        cust.filter("customer_id in (1, 2)"), "customer_id",
        restrict={"orders": (ords, "customer_id")},
        cascade={"customer_loyalty": (seeds.customer_loyalty(spark), "customer_id")},
    ).collect()}
    assert out == {1: "RESTRICTED", 2: "DELETED"}


def test_g7_alert_bands(spark):
    levels = [2, 3, 4, 5, 10, 11]
    before = spark.createDataFrame([(i, 100, 10) for i in range(6)],
                                   "product_id long, quantity_on_hand int, reorder_point int")
    after = spark.createDataFrame([(i, q, 10) for i, q in enumerate(levels)],
                                  "product_id long, quantity_on_hand int, reorder_point int")
    prod = spark.createDataFrame([(i, f"p{i}") for i in range(6)], "product_id long, product_name string")
    got = {r["product_id"]: r["alert_level"] for r in rules.low_stock_alerts(before, after, prod, seeds.NOW).collect()}
    assert got == {0: "CRITICAL", 1: "WARNING", 2: "WARNING", 3: "INFO", 4: "INFO"}


def test_g10_tiers(spark):
    cl = spark.createDataFrame(
        [(1, D("499.99"), 0, "Silver"), (2, D("500.00"), 0, "Bronze"), (3, D("2000.00"), 0, "Bronze"),
         (4, D("5000.00"), 0, "Bronze"), (5, D("10.00"), 0, None)],
        "customer_id long, total_spent decimal(12,2), loyalty_points int, loyalty_tier string",
    )
    tiers = {r["customer_id"]: r["loyalty_tier"] for r in loyalty.loyalty_tiers(cl, dt.date(2025, 1, 1)).collect()}
    assert tiers == {1: "Bronze", 2: "Silver", 3: "Gold", 4: "Platinum", 5: None}
    changes = {r["customer_id"]: r["description"] for r in loyalty.loyalty_tier_changes(cl, dt.date(2025, 1, 1)).collect()}
    assert changes[1] == "Upgraded from Silver to Bronze"  # downgrades keep the reference's wording
    assert 5 not in changes


def test_promotion_cap_first_come(spark):
    promos = seeds.promotions(spark).withColumn("max_uses_total", F.lit(2)).withColumn("times_used", F.lit(1))
    reqs = seeds.requests(spark, [
        (i, i, 1, '[{"product_id": 5, "quantity": 2}]', "STANDARD", "EARLY15") for i in range(1, 4)
    ])
    b = order_batch(reqs, seeds.customer(spark), seeds.product(spark), seeds.inventory(spark), promos)
    granted = sorted(r["order_id"] for r in orders.promotion_usage(b.accepted).collect())
    assert granted == [1]

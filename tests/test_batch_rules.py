"""Batches with poison requests, long orders, repeated returns and chained snapshots."""

import datetime as dt
import json
import random
import tempfile
from decimal import Decimal as D

import pytest
import seeds
from stockroom.operators import loyalty, orders, returns
from stockroom.plans import jobs
from stockroom.plans.order_batch import order_batch
from stockroom.plans.side_batches import RestockBatch, ReturnBatch

ORDERS = "order_id long, customer_id long, order_date timestamp_ntz, total_amount decimal(10,2), order_status string"
ITEMS = "order_item_id long, order_id long, product_id long, quantity int, unit_price decimal(10,2)"
INT_MAX = 2**31 - 1
RETURNS = "request_id long, order_id long, items_json string, return_reason string, refund_method string"


def _item(product, quantity):
    return {"product_id": product, "quantity": quantity}


def test_poison_requests_are_quarantined(spark):
    bad = {
        1: [_item(1, 2_000_000_000), _item(1, 2_000_000_000)],  # sum beyond INT
        2: [_item(2, 2_000_000_000)],  # amount beyond DECIMAL(10,2)
        3: [_item(1, 9_000_000_000_000_000_000), _item(1, 9_000_000_000_000_000_000)],  # sum beyond BIGINT
        4: [_item(1, 10**30)],  # no number of ours: no valid line
    }
    rows = [(k, k, 1, json.dumps(v), "STANDARD", None) for k, v in bad.items()] + [(5, 9, 1, json.dumps([_item(5, 2)]), "STANDARD", None)]
    b = order_batch(seeds.requests(spark, rows), seeds.customer(spark), seeds.product(spark), seeds.inventory(spark), seeds.promotions(spark))
    got = {r["request_id"]: r for r in orders.order_results(b.decided).collect()}
    assert got[5]["status"] == "SUCCESS" and got[5]["subtotal"] == D("70.00")
    assert {got[k]["message"] for k in (1, 2, 3)} == {"Order quantity or amount is out of range"}
    assert got[4]["message"] == "No valid order items provided"
    assert {r["error_id"] for r in orders.rejected_requests(b.decided).collect()} == {1, 2, 3, 4}


def test_long_orders_keep_unique_line_ids(spark):
    n = 1200
    product = spark.range(1, n + 1).selectExpr("id as product_id", "concat('p', id) as product_name", "1 as category_id",
                                               "concat('s', id) as sku", "cast(1 as decimal(10,2)) as price", "true as is_active")
    stock = spark.range(1, n + 1).selectExpr("id as product_id", "9 as quantity_on_hand", "0 as quantity_reserved", "9 as quantity_available",
                                             "1 as reorder_point", "1 as reorder_quantity", "cast(null as date) as last_restock_date")
    rows = [(k, k, 1, json.dumps([_item(p, 1) for p in range(1, n + 1)]), "STANDARD", None) for k in (1, 2)]
    b = order_batch(seeds.requests(spark, rows), seeds.customer(spark), product, stock, seeds.promotions(spark))
    lines = b.accepted_lines
    assert lines.count() == 2 * n and lines.select("order_item_id").distinct().count() == 2 * n


def _return_batch(spark, requests):
    orders_df = spark.createDataFrame([(10, 1, dt.datetime(2025, 1, 1), D("100.00"), "Delivered")], ORDERS)
    items = spark.createDataFrame([(1001, 10, 5, 2, D("35.00"))], ITEMS)
    return ReturnBatch(spark.createDataFrame(requests, RETURNS), items, orders_df, seeds.NOW)


def _return(quantity, condition="New", item=1001):
    return json.dumps([{"order_item_id": item, "quantity": quantity, "condition": condition}])


def test_one_return_for_an_order(spark):
    rb = _return_batch(spark, [(7, 10, _return(3), "r", "card"), (8, 10, _return(2), "r", "card"), (9, 10, _return(2), "r", "card")])
    checks = {r["request_id"]: (r["failed_rule"], r["message"]) for r in rb.checks.collect()}
    assert checks[7][0] == 4  # fails by itself, so it does not close the order
    assert checks[8][0] is None
    assert checks[9] == (1, "Order ID 10 does not exist or cannot be returned")
    assert [r["refund_amount"] for r in rb.posted.collect()] == [D("70.00")]
    stock = {r["product_id"]: r["quantity_on_hand"] for r in returns.return_inventory(seeds.inventory(spark), rb.priced_lines).collect()}
    assert stock[5] == 172


def test_null_items_and_zero_quantities_of_returns(spark):
    two = json.dumps([{"order_item_id": 1001, "quantity": 1, "condition": "New"}, {"order_item_id": 1001, "quantity": 0, "condition": "New"}])
    rb = _return_batch(spark, [(1, 10, None, "r", "card"), (2, 10, "nope", "r", "card"), (3, 10, two, "r", "card")])
    checks = {r["request_id"]: r["message"] for r in rb.checks.collect()}
    assert checks == {1: "No valid return items provided", 2: "Invalid return items JSON", 3: "Return quantity must be greater than 0"}


def test_snapshots_chain_and_keep_their_columns(spark):
    root = tempfile.mkdtemp(prefix="stockroom-chain-", dir="/tmp")
    balance = spark.createDataFrame([(c, D("0.00"), 100, "Bronze", 100, 7) for c in (1, 2, 3)],
                                    "customer_id long, total_spent decimal(12,2), loyalty_points int, loyalty_tier string, points_earned int, points_redeemed int")

    def order(batch_id, request_id, stock, points):
        reqs = seeds.requests(spark, [(request_id, request_id, 1, json.dumps([_item(5, 2)]), "STANDARD", None)])
        b = order_batch(reqs, seeds.customer(spark), seeds.product(spark), stock, seeds.promotions(spark))
        jobs.write_order_batch(b, seeds.promotions(spark), points, root, batch_id)

    def latest(table):
        return jobs.latest_snapshot(spark, root, table)

    assert latest("inventory") is None
    order("b9", 10, seeds.inventory(spark), balance)
    earned = latest("customer_loyalty").filter("customer_id = 1").first()
    assert (earned["loyalty_points"], earned["points_earned"], earned["points_redeemed"]) == (108, 108, 7)
    sold = latest("inventory").filter("product_id = 5").first()["last_sale_date"]
    assert sold is not None
    rb = _return_batch(spark, [(10, 10, _return(2), "r", "card")])
    jobs.write_return_batch(rb, latest("inventory"), latest("customer_loyalty"), root, "a1", "tester")
    back = latest("customer_loyalty").filter("customer_id = 1").first()
    assert (back["loyalty_points"], back["points_earned"], back["points_redeemed"]) == (101, 108, 14)
    restock = spark.createDataFrame([(1, 5, 3, None, None, D("1.00"), dt.date(2026, 1, 1)), (2, 6, 3, "LOT-8", None, D("1.00"), dt.date(2026, 1, 1))],
                                    "restock_id long, product_id long, quantity int, batch_number string, supplier_id long, unit_cost decimal(10,2), expiration_date date")
    alerts = spark.createDataFrame([], "product_id long, alert_level string, current_quantity int, reorder_point int, resolved boolean")
    job = RestockBatch(restock, seeds.product(spark), seeds.suppliers(spark), latest("inventory"), seeds.NOW, "tester")
    jobs.write_restock_batch(job, alerts, root, "007")
    row = latest("inventory").filter("product_id = 5").first()
    assert row["last_sale_date"] == sold and row["quantity_on_hand"] == 170 + 2 + 3
    assert spark.read.parquet(f"{root}/inventory_batch").first()["expiration_date"] == dt.date(2026, 1, 1)
    order("b10", 11, latest("inventory"), latest("customer_loyalty"))
    again = latest("customer_loyalty").filter("customer_id = 1").first()
    assert (again["loyalty_points"], again["points_earned"], again["points_redeemed"]) == (109, 116, 14)
    assert {"points_earned", "points_redeemed"} <= set(loyalty.loyalty_tiers(latest("customer_loyalty"), seeds.NOW.date()).columns)


def test_rerun_without_rows_clears_its_partition(spark):
    root = tempfile.mkdtemp(prefix="stockroom-rerun-", dir="/tmp")

    def run(items):
        reqs = seeds.requests(spark, [(1, 0, 1, items, "STANDARD", None), (2, 1, 1, json.dumps([_item(5, 1)]), "STANDARD", None)])
        b = order_batch(reqs, seeds.customer(spark), seeds.product(spark), seeds.inventory(spark), seeds.promotions(spark))
        jobs.write_order_batch(b, seeds.promotions(spark), seeds.customer_loyalty(spark), root, "b1")
        return spark.read.parquet(f"{root}/system_error_log").count()

    assert run("nope") == 1
    assert run(json.dumps([_item(5, 1)])) == 0


def _serial_levels(rows, level):
    refused = set()
    for rid, q in rows:
        if level + q > INT_MAX:
            refused.add(rid)
        else:
            level += q
    return refused, level


def test_poison_restocks_do_not_stop_the_batch(spark):
    """A restock that does not fit below the largest INT is refused by itself;
    smaller ones behind it still go in, as one by one."""
    draw = random.Random(4)
    rows = [(k, 1, draw.choice([1, 50, 2**29, 2**30, INT_MAX, INT_MAX - 170])) for k in range(1, 40)] + [(100, 5, 3), (101, 5, INT_MAX)]
    restock_rows = [(k, p, q, None, None, D("1.00"), None) for k, p, q in rows]
    schema = "restock_id long, product_id long, quantity int, batch_number string, supplier_id long, unit_cost decimal(10,2), expiration_date date"
    stock = seeds.inventory(spark)
    held = {r["product_id"]: r["quantity_on_hand"] for r in stock.collect()}
    b = RestockBatch(spark.createDataFrame(restock_rows, schema), seeds.product(spark), seeds.suppliers(spark), stock, seeds.NOW, "tester")
    refused, level = _serial_levels([(k, q) for k, p, q in rows if p == 1], held[1])
    assert refused and {r["restock_id"] for r in b.checks.filter("failed_rule = 5").collect()} == refused | {101}
    after = {r["product_id"]: r["quantity_on_hand"] for r in b.inventory_after().collect()}
    assert after[1] == level and after[5] == held[5] + 3
    messages = {r["restock_id"]: r["message"] for r in b.results().collect()}
    assert messages[101] == "Restock quantity or stock level is out of range"
    assert b.movements.count() == len(rows) - len(refused) - 1


@pytest.mark.parametrize("price, fits", [("84745758.46", True), ("84745758.48", False)])
def test_the_real_total_decides_the_range(spark, price, fits):
    """Subtotal, 18 % tax and 5.00 shipping against DECIMAL(10,2)."""
    product = spark.createDataFrame([(1, "p", 1, "s", D(price), True)], "product_id long, product_name string, category_id int, sku string, price decimal(10,2), is_active boolean")
    rows = [(1, 1, 1, json.dumps([_item(1, 1)]), "STANDARD", None)]
    b = order_batch(seeds.requests(spark, rows), seeds.customer(spark), product, seeds.inventory(spark), seeds.promotions(spark))
    assert (orders.order_results(b.decided).first()["status"] == "SUCCESS") == fits


def test_ids_without_room_are_refused(spark):
    rows = [(9_000_000_000_001, 1, 1, json.dumps([_item(5, 1)]), "STANDARD", None), (7, 2, 1, json.dumps([_item(5, 1)]), "STANDARD", None)]
    b = order_batch(seeds.requests(spark, rows), seeds.customer(spark), seeds.product(spark), seeds.inventory(spark), seeds.promotions(spark))
    got = {r["request_id"]: r["status"] for r in orders.order_results(b.decided).collect()}
    assert got == {9_000_000_000_001: "ERROR", 7: "SUCCESS"} and b.accepted_lines.count() == 1


def test_balances_stop_at_their_range(spark):
    loyalty_rows = spark.createDataFrame([(1, D("9999999999.00"), INT_MAX - 1, "Gold", 0)], "customer_id long, total_spent decimal(12,2), loyalty_points int, loyalty_tier string, points_earned int")
    accepted = spark.createDataFrame([(1, D("700.00"))], "customer_id long, total_amount decimal(10,2)")
    accrual = spark.createDataFrame([(1, 70)], "customer_id long, points_change int")
    row = orders.loyalty_balances(loyalty_rows, accrual, accepted).first()
    assert (row["loyalty_points"], row["points_earned"], row["total_spent"]) == (INT_MAX, 70, D("9999999999.99"))

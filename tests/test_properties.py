"""Invariants of the order batch on real data (sf0.001, scarce stock)."""

import pytest
from pyspark.sql import functions as F

import seeds
from conftest import SF0001
from stockroom.operators import kpis, orders
from stockroom.operators.allocate import allocate_lines, allocation_outcomes
from stockroom.plans.order_batch import order_batch
from stockroom.sources.fixtures import Fixtures


@pytest.fixture(scope="module")
def batch(spark):
    f = Fixtures(spark, SF0001)
    b = order_batch(f.order_requests, f.customer, f.product, f.inventory, f.promotions, stage_requests=True)
    return f, b


def test_accepted_demand_never_exceeds_stock(batch):
    _, b = batch
    over = (
        b.allocated.filter(F.col("accepted"))
        .groupBy("product_id")
        .agg(F.sum("quantity").alias("demand"), F.first("stock").alias("stock"))
        .filter(F.col("demand") > F.col("stock"))
    )
    assert over.count() == 0


def test_ledger_sums_equal_reservation_change(batch):
    f, b = batch
    moved = orders.order_movements(b.accepted_lines).groupBy("product_id").agg(
        (-F.sum("quantity_change")).alias("moved"))
    after = orders.reserve_inventory(f.inventory, b.accepted_lines).select(
        "product_id", F.col("quantity_reserved").alias("r1"))
    before = f.inventory.select("product_id", F.col("quantity_reserved").alias("r0"))
    j = after.join(before, "product_id").join(moved, "product_id", "left")
    assert j.filter(F.col("r1") - F.col("r0") != F.coalesce(F.col("moved"), F.lit(0))).count() == 0
    # each product's ledger is a chain: new = previous - quantity, next previous = this new
    chain = orders.order_movements(b.accepted_lines).toPandas().sort_values(["product_id", "log_date", "reference_id"])
    for _, g in chain.groupby("product_id"):
        assert (g["previous_quantity"].iloc[1:].values == g["new_quantity"].iloc[:-1].values).all()


def test_points_balance_equals_ledger(batch):
    f, b = batch
    accrual = orders.loyalty_accrual(b.accepted)
    bal = orders.loyalty_balances(f.customer_loyalty, accrual, b.accepted)
    earned = accrual.groupBy("customer_id").agg(F.sum("points_change").alias("pts"))
    j = bal.join(f.customer_loyalty.select("customer_id", F.col("loyalty_points").alias("p0")), "customer_id") \
        .join(earned, "customer_id", "left")
    assert j.filter(F.col("loyalty_points") - F.col("p0") != F.coalesce(F.col("pts"), F.lit(0))).count() == 0


def test_totals_equal_components(batch):
    _, b = batch
    a = b.accepted
    bad = a.filter(F.col("total_amount") != F.col("subtotal") + F.col("tax_amount")
                   + F.col("shipping_amount") - F.col("discount_amount"))
    assert bad.count() == 0
    results = orders.order_results(b.decided)
    assert results.count() == b.requests.count()
    assert results.filter("status = 'ERROR' and message is null").count() == 0


def test_empty_inputs(spark):
    empty_lines = spark.createDataFrame([], "request_id long, request_ts timestamp_ntz, product_id long, quantity int")
    inv = spark.createDataFrame([(1, 5)], "product_id long, quantity_available int")
    assert allocation_outcomes(allocate_lines(empty_lines, inv)).count() == 0
    b = order_batch(seeds.requests(spark, []), seeds.customer(spark), seeds.product(spark),
                    seeds.inventory(spark), seeds.promotions(spark))
    assert orders.order_results(b.decided).count() == 0
    no_orders = spark.createDataFrame([], "order_id long, customer_id long, order_date timestamp_ntz, "
                                          "total_amount decimal(10,2), order_status string")
    k1 = {r["customer_id"]: r for r in kpis.customer_sales_summary(seeds.customer(spark), no_orders).collect()}
    assert k1[1]["total_spent"] == 0 and k1[1]["total_orders"] == 0 and k1[1]["avg_order_value"] is None
    rev = kpis.total_revenue(no_orders).collect()
    assert rev[0]["Value"] is None


def test_same_day_orders_break_ties_by_id(spark):
    o = spark.createDataFrame(
        [(2, 1, "2024-01-01 00:00:00"), (1, 1, "2024-01-01 00:00:00"), (3, 1, "2024-01-03 00:00:00")],
        "order_id long, customer_id long, order_date string",
    ).withColumn("order_date", F.col("order_date").cast("timestamp_ntz"))
    freq = {r["order_id"]: r for r in kpis.customer_order_frequency(o, seeds.customer(spark)).collect()}
    assert freq[1]["previous_order_date"] is None
    assert freq[2]["days_since_last_order"] == 0
    assert freq[3]["days_since_last_order"] == 2

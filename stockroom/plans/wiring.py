"""Binds fixture views to operators: one registered query per operator."""

from __future__ import annotations

import datetime as _dt
import uuid
from functools import reduce

from pyspark.sql import functions as F

from stockroom.functions.clock import ts_lit
from stockroom.operators import cascade, catalogue, health, kpis, loyalty, orders, quality, restock, returns, rules
from stockroom.plans import jobs as jobs_
from stockroom.plans.order_batch import order_batch
from stockroom.plans.registry import query
from stockroom.plans.side_batches import RestockBatch, ReturnBatch
from stockroom.session import scratch_path
from stockroom.sources.fixtures import LOG_DATE, OPERATOR, REPORT_DATE, Fixtures
from stockroom.streaming import feeds, jobs

STOCK_POSITION_IDS = (1, 5, 42, 1999)
MOVEMENT_REFERENCE = 56
STORED_REFERENCE = 8_000_003
RETENTION_LIMIT = _dt.datetime(2024, 1, 16, 9, 30)
SHIPPING_METHODS = ("STANDARD", "EXPRESS", "OVERNIGHT")
AS_OF_TS = _dt.datetime(REPORT_DATE.year, REPORT_DATE.month, REPORT_DATE.day)
DAY = 86400


# ------------------------------------------------------------------ K ----
@query("customer_sales_summary")
def _k1(f: Fixtures):
    return kpis.customer_sales_summary(f.customer, f.orders)


@query("total_revenue")
def _k2(f: Fixtures):
    return kpis.total_revenue(f.orders)


@query("top_customers")
def _k3(f: Fixtures):
    return kpis.top_customers(kpis.customer_sales_summary(f.customer, f.orders), n=10)


@query("best_selling_products")
def _k4(f: Fixtures):
    return kpis.best_selling_products(f.order_item, f.product, f.orders, n=5)


@query("best_selling_products_all")
def _k4b(f: Fixtures):
    return kpis.best_selling_products(f.order_item, f.product, f.orders, n=5, exclude_status=False)


@query("monthly_sales_trend")
def _k5(f: Fixtures):
    return kpis.monthly_sales_trend(f.orders)


@query("category_sales_rank")
def _k6(f: Fixtures):
    return kpis.category_sales_rank(f.order_item, f.product, f.product_category, f.orders)


@query("customer_order_frequency")
def _k7(f: Fixtures):
    return kpis.customer_order_frequency(f.orders, f.customer)


# ------------------------------------------------------------------ H ----


@query("quantity_on_order")
def _h1a(f: Fixtures):
    return health.quantity_on_order(f.purchase_order_items, f.purchase_orders)


@query("critical_stock")
def _h1(f: Fixtures):
    return health.critical_stock(
        f.product, f.product_category, f.inventory, f.order_item, f.orders,
        f.purchase_orders, f.purchase_order_items, as_of=REPORT_DATE,
    )


@query("slow_moving_inventory")
def _h2(f: Fixtures):
    return health.slow_moving_inventory(
        f.product, f.product_category, f.inventory_with_last_sale, f.order_item, f.orders,
        as_of=REPORT_DATE,
    )


@query("slow_moving_inventory_literal")
def _h2b(f: Fixtures):
    return health.slow_moving_inventory(
        f.product, f.product_category, f.inventory_with_last_sale, f.order_item, f.orders,
        as_of=REPORT_DATE, literal=True,
    )


def _integrity_parts(f: Fixtures):
    return [
        health.orphaned_order_items(f.order_item_broken, f.orders),
        health.orphaned_inventory(f.inventory_broken, f.product),
        health.negative_inventory(f.inventory_minus5),
        health.inactive_products_with_stock(f.product, f.inventory),
        health.invalid_customer_emails(f.customer),
        health.orders_total_mismatch(f.orders, f.order_item),
    ]


@query("orphaned_order_items")
def _h3(f: Fixtures):
    return health.orphaned_order_items(f.order_item_broken, f.orders)


@query("orphaned_inventory")
def _h4(f: Fixtures):
    return health.orphaned_inventory(f.inventory_broken, f.product)


@query("negative_inventory")
def _h5(f: Fixtures):
    return health.negative_inventory(f.inventory_minus5)


@query("inactive_products_with_stock")
def _h6(f: Fixtures):
    return health.inactive_products_with_stock(f.product, f.inventory)


@query("invalid_customer_emails")
def _h7(f: Fixtures):
    return health.invalid_customer_emails(f.customer)


@query("orders_total_mismatch")
def _h8(f: Fixtures):
    return health.orders_total_mismatch(f.orders, f.order_item)


@query("data_integrity_report")
def _h9(f: Fixtures):
    return health.data_integrity_report(_integrity_parts(f))


@query("unresolved_errors_by_severity")
def _h10(f: Fixtures):
    return health.unresolved_errors_by_severity(f.system_error_log)


@query("active_alerts_by_level")
def _h11(f: Fixtures):
    return health.active_alerts_by_level(f.low_stock_alerts)


@query("system_status")
def _h12(f: Fixtures):
    return health.system_status(f.orders, f.low_stock_alerts, f.system_error_log, f.active_connections_log)


@query("recent_errors")
def _h13(f: Fixtures):
    return health.recent_errors(f.system_error_log, n=10)


@query("slow_queries")
def _h14(f: Fixtures):
    return health.slow_queries(f.query_performance_log, threshold_ms=1000, n=10)


@query("log_retention")
def _h15(f: Fixtures):
    return health.log_retention(f.query_performance_log, "log_time", as_of=LOG_DATE, days=7)


@query("log_retention_connections")
def _h15b(f: Fixtures):
    return health.log_retention(f.active_connections_log, "logged_at", as_of=LOG_DATE, days=1)


@query("stock_position")
def _h16(f: Fixtures):
    return health.stock_position(f.inventory, f.product, STOCK_POSITION_IDS)


@query("entity_counts")
def _h18(f: Fixtures):
    return health.entity_counts(
        {
            "customer": f.customer,
            "product": f.product,
            "inventory": f.inventory,
            "orders": f.orders,
            "order_item": f.order_item,
        }
    )


# ------------------------------------------------------------------ C ----
@query("unique_violations")
def _c1(f: Fixtures):
    return quality.unique_violations(f.table("lineitem"), ["l_orderkey", "l_linenumber"])


@query("unique_violations_email")
def _c1b(f: Fixtures):
    return quality.unique_violations(f.customer, ["email"])


@query("foreign_key_violations")
def _c2(f: Fixtures):
    return quality.foreign_key_violations(
        f.order_item_broken, f.orders, {"order_id": "order_id"},
        keep=["order_item_id", "order_id", "product_id"],
    )


def inventory_rules() -> dict:
    """Declared CHECK constraints of the stock table."""
    return {
        "on_hand_non_negative": F.col("quantity_on_hand") >= 0,
        "reserved_non_negative": F.col("quantity_reserved") >= 0,
        "reorder_point_non_negative": F.col("reorder_point") >= 0,
        "reorder_quantity_positive": F.col("reorder_quantity") > 0,
    }


@query("check_violations")
def _c3(f: Fixtures):
    return quality.check_violations(f.inventory_minus5, inventory_rules(), keep=["product_id"])


@query("enum_violations")
def _c4(f: Fixtures):
    return quality.enum_violations(
        f.order_request_heads, "shipping_method", SHIPPING_METHODS, keep=["request_id"]
    )


@query("apply_defaults")
def _c5(f: Fixtures):
    return quality.apply_defaults(
        f.product,
        {
            "is_active": F.lit(True),
            "rating": F.lit(0).cast("decimal(3,2)"),
            "review_count": F.lit(0),
            "cost_price": F.lit(None).cast("decimal(10,2)"),
        },
    )


def _upsert_inputs(f: Fixtures):
    """All customers twice: a third of the incoming rows have new ids."""
    key = F.col("customer_id")
    source = f.customer.withColumns({
        "full_name": F.upper("full_name"),
        "customer_id": F.when(key % 3 == 0, key + 1_000_000_000).otherwise(key),
    })
    return f.customer, source


@query("upsert")
def _c6(f: Fixtures):
    target, source = _upsert_inputs(f)
    return quality.upsert(target, source, ["customer_id"], mode="update")


@query("upsert_ignore")
def _c6b(f: Fixtures):
    target, source = _upsert_inputs(f)
    return quality.upsert(target, source, ["customer_id"], mode="ignore")


@query("delete_cascade_restrict")
def _c7(f: Fixtures):
    requests = f.customer.select("customer_id")
    return quality.delete_cascade_restrict(
        requests,
        "customer_id",
        restrict={"orders": (f.orders, "customer_id")},
        cascade={"customer_loyalty": (f.customer_loyalty, "customer_id")},
    )


# The declared constraints of the tables.
EMAIL = "email RLIKE '^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\\\.[A-Za-z]{2,}$'"
DECLARED = [
    catalogue.Table("customer", "customer_id", ["full_name", "email"], {"email": ["email"]}, {"email_format": EMAIL}),
    catalogue.Table("customer_loyalty", "loyalty_id", ["customer_id"], {"customer_id": ["customer_id"]},
                    lists={"loyalty_tier": ["Bronze", "Silver", "Gold", "Platinum"]}, references={"customer_id": "customer"}),
    catalogue.Table("product_category", "category_id", ["category_name"], {"category_name": ["category_name"]}),
    catalogue.Table("product", "product_id", ["product_name", "category_id", "price"], {"product_name": ["product_name"], "sku": ["sku"]},
                    {"price_non_negative": "price >= 0"}, references={"category_id": "product_category"}),
    catalogue.Table("suppliers", "supplier_id", ["supplier_name"]),
    catalogue.Table("inventory", "inventory_id", ["product_id", "quantity_on_hand", "quantity_reserved", "reorder_point", "reorder_quantity"],
                    {"product_id": ["product_id"]},
                    {"on_hand_non_negative": "quantity_on_hand >= 0", "reserved_non_negative": "quantity_reserved >= 0",
                     "reorder_point_non_negative": "reorder_point >= 0", "reorder_quantity_positive": "reorder_quantity > 0"},
                    references={"product_id": "product"}),
    catalogue.Table("promotions", "promotion_id", ["promotion_code", "promotion_type", "discount_value", "valid_from", "valid_to"],
                    {"promotion_code": ["promotion_code"]}, lists={"promotion_type": ["Percentage", "Fixed Amount", "Free Shipping"]}),
    catalogue.Table("orders", "order_id", ["customer_id", "total_amount"], {}, {"total_non_negative": "total_amount >= 0"},
                    {"order_status": ["Pending", "Processing", "Shipped", "Delivered", "Cancelled", "Returned"]}, {"customer_id": "customer"}),
    catalogue.Table("order_item", "order_item_id", ["order_id", "product_id", "quantity", "unit_price"], {},
                    {"quantity_positive": "quantity > 0", "unit_price_non_negative": "unit_price >= 0"},
                    references={"order_id": "orders", "product_id": "product"}),
    catalogue.Table("low_stock_alerts", "alert_id", ["product_id"], lists={"alert_level": ["INFO", "WARNING", "CRITICAL"]},
                    references={"product_id": "product"}),
    catalogue.Table("system_error_log", "error_id", lists={"severity": ["LOW", "MEDIUM", "HIGH", "CRITICAL"]}),
]


@query("constraint_violations")
def _c1_4(f: Fixtures):
    """C1-C4 over all declared constraints of tables that break each of them."""
    return catalogue.violations(DECLARED, f.broken_tables)


REFERENCES = [
    cascade.Reference("customer_loyalty", "customer_id", "customer", cascade.CASCADE),
    cascade.Reference("orders", "customer_id", "customer"),
    cascade.Reference("order_item", "order_id", "orders", cascade.CASCADE),
    cascade.Reference("order_item", "product_id", "product"),
    cascade.Reference("shipping_info", "order_id", "orders", cascade.CASCADE),
    cascade.Reference("returns", "order_id", "orders"),
    cascade.Reference("returns", "customer_id", "customer"),
    cascade.Reference("return_items", "return_id", "returns", cascade.CASCADE),
    cascade.Reference("return_items", "product_id", "product"),
    cascade.Reference("inventory", "product_id", "product", cascade.CASCADE),
]
DELETE_KEYS = {
    "customer": "customer_id", "customer_loyalty": "customer_id", "orders": "order_id", "order_item": "order_item_id",
    "shipping_info": "shipping_id", "returns": "return_id", "return_items": "return_item_id", "product": "product_id", "inventory": "product_id",
}


def _deletion(f: Fixtures) -> cascade.Deletion:
    return cascade.Deletion(f.delete_requests, {t: getattr(f, t) for t in DELETE_KEYS}, DELETE_KEYS, REFERENCES)


@query("delete_outcomes")
def _c7b(f: Fixtures):
    """C7 over the whole reference graph: the fate of every request."""
    return _deletion(f).outcomes()


@query("delete_survivors")
def _c7c(f: Fixtures):
    """The rows of every table that are left."""
    done = _deletion(f)
    left = [done.survivors(t).select(F.lit(t).alias("table"), F.col(k).cast("long").alias("key")) for t, k in DELETE_KEYS.items()]
    return reduce(lambda a, b: a.unionByName(b), left)


# ------------------------------------------------------------------ O ----


def _batch(f: Fixtures, ample: bool = True):
    inv = f.inventory_ample if ample else f.inventory
    # the fixture request table is derived (JSON built from lineitem): stage it
    return order_batch(f.order_requests, f.customer, f.product, inv, f.promotions, stage_requests=True)


@query("parse_order_requests")
def _o1(f: Fixtures):
    return orders.parse_order_requests(f.order_requests)


@query("validate_order_requests")
def _o2(f: Fixtures):
    lines = orders.parse_order_requests(f.order_requests)
    enriched = orders.enrich_lines(lines, f.product, f.inventory_ample)
    return orders.validate_order_requests(f.order_requests, enriched, f.customer)


@query("price_orders")
def _o3(f: Fixtures):
    return _batch(f).priced


@query("apply_promotions")
def _o4(f: Fixtures):
    return _batch(f).promoted.select(
        "request_id", "promotion_id", "discount_amount", "shipping_amount", "total_amount"
    )


@query("allocate_stock")
def _o5(f: Fixtures):
    """Scarce (real) stock: the serial-consistent fixpoint. Its oracle is a
    recursive CTE that runs the serial loop literally; tests also compare
    it with a Python serial loop."""
    return _batch(f, ample=False).outcomes


@query("post_orders")
def _o6(f: Fixtures):
    return orders.post_orders(_batch(f).accepted)


@query("post_order_items")
def _o6b(f: Fixtures):
    return orders.post_order_items(_batch(f).accepted_lines)


@query("reserve_inventory")
def _o7(f: Fixtures):
    return orders.reserve_inventory(f.inventory_ample, _batch(f).accepted_lines)


@query("order_movements")
def _o8(f: Fixtures):
    return orders.order_movements(_batch(f).accepted_lines)


@query("promotion_usage")
def _o9(f: Fixtures):
    return orders.promotion_usage(_batch(f).accepted)


@query("promotion_times_used")
def _o9b(f: Fixtures):
    return orders.promotion_times_used(f.promotions, orders.promotion_usage(_batch(f).accepted))


@query("shipping_plan")
def _o10(f: Fixtures):
    return orders.shipping_plan(_batch(f).accepted)


@query("loyalty_accrual")
def _o11(f: Fixtures):
    return orders.loyalty_accrual(_batch(f).accepted)


@query("loyalty_balances")
def _o11b(f: Fixtures):
    b = _batch(f)
    return orders.loyalty_balances(f.customer_loyalty, orders.loyalty_accrual(b.accepted), b.accepted)


@query("order_results")
def _o12(f: Fixtures):
    return orders.order_results(_batch(f).decided)


@query("rejected_requests")
def _o13(f: Fixtures):
    return orders.rejected_requests(_batch(f).rejected)


@query("orders_total_mismatch_components")
def _h8b(f: Fixtures):
    b = _batch(f)
    return health.orders_total_mismatch_components(
        orders.post_orders(b.accepted), orders.post_order_items(b.accepted_lines)
    )


@query("movements_by_reference")
def _h17(f: Fixtures):
    return health.movements_by_reference(
        orders.order_movements(_batch(f).accepted_lines), MOVEMENT_REFERENCE, "orders", n=5
    )


@query("movements_by_reference_stored")
def _h17b(f: Fixtures):
    """H17 as it runs in production: the restock job's ledger is written, and
    the lookup reads the files of that reference only."""
    root = scratch_path(f.spark, "ledger-" + _uuid())
    jobs_.write_ledger(_restock(f).movements, root, "restocks")
    return jobs_.ledger_by_reference(f.spark, root, STORED_REFERENCE, "inventory_batch")


@query("log_retention_by_day")
def _h15c(f: Fixtures):
    """H15 on a log stored by day: whole days are dropped, the limit's own day
    loses its older rows."""
    path, log = scratch_path(f.spark, "log-" + _uuid()), f.query_performance_log
    jobs_.write_log_by_day(log, "log_time", path)
    jobs_.drop_old_days(f.spark, path, "log_time", log.schema, RETENTION_LIMIT)
    return jobs_.read_log_by_day(f.spark, path, log.schema)


# ------------------------------------------------------------- R, T ----


def _restock(f: Fixtures) -> RestockBatch:
    # the fixture restock table is derived from order items: stage it
    return RestockBatch(f.restocks, f.product, f.suppliers, f.inventory, AS_OF_TS, OPERATOR, stage_requests=True)


@query("validate_restocks")
def _r1(f: Fixtures):
    return _restock(f).checks


@query("restock_batches")
def _r2(f: Fixtures):
    return _restock(f).batches()


@query("apply_restocks")
def _r3(f: Fixtures):
    return _restock(f).inventory_after()


@query("restock_movements")
def _r4(f: Fixtures):
    return _restock(f).movements


@query("resolve_alerts")
def _r5(f: Fixtures):
    return _restock(f).resolved(f.low_stock_alerts)


@query("restock_results")
def _r6(f: Fixtures):
    return _restock(f).results()


def _returns(f: Fixtures) -> ReturnBatch:
    # the fixture return requests are derived (JSON built from order items): stage them
    return ReturnBatch(f.return_requests, f.order_item, f.orders, AS_OF_TS, stage_requests=True)


@query("parse_return_requests")
def _t1(f: Fixtures):
    return _returns(f).lines


@query("validate_returns")
def _t2(f: Fixtures):
    return _returns(f).checks


@query("price_returns")
def _t3(f: Fixtures):
    return _returns(f).refunds


@query("post_returns")
def _t4(f: Fixtures):
    return _returns(f).posted


@query("post_return_items")
def _t4b(f: Fixtures):
    return returns.post_return_items(_returns(f).priced_lines)


@query("mark_orders_returned")
def _t5(f: Fixtures):
    return returns.mark_orders_returned(f.orders, _returns(f).posted)


@query("return_restock")
def _t6(f: Fixtures):
    batch = _returns(f)
    return returns.return_restock_movements(batch.priced_lines, f.inventory, AS_OF_TS, OPERATOR, batch.lines)


@query("return_inventory")
def _t6b(f: Fixtures):
    return returns.return_inventory(f.inventory, _returns(f).priced_lines)


@query("restocked_quantity")
def _t7(f: Fixtures):
    return returns.post_return_items(_returns(f).priced_lines).select(
        "return_item_id", "order_item_id", "restocked_quantity"
    )


@query("loyalty_clawback")
def _t8(f: Fixtures):
    return returns.loyalty_clawback(_returns(f).posted, AS_OF_TS)


@query("loyalty_clawback_balances")
def _t8b(f: Fixtures):
    return returns.clawback_balances(f.customer_loyalty, returns.loyalty_clawback(_returns(f).posted, AS_OF_TS))


@query("return_results")
def _t9(f: Fixtures):
    return _returns(f).results()


# ------------------------------------------------------------- L, A ----
@query("loyalty_tiers")
def _l1(f: Fixtures):
    return loyalty.loyalty_tiers(f.customer_loyalty, REPORT_DATE)


@query("loyalty_tier_changes")
def _l2(f: Fixtures):
    return loyalty.loyalty_tier_changes(f.customer_loyalty, REPORT_DATE)


@query("customer_lifetime_value")
def _l3(f: Fixtures):
    return loyalty.customer_lifetime_value(f.customer, f.customer_loyalty, f.orders)


@query("low_stock_alerts")
def _a1(f: Fixtures):
    return rules.low_stock_alerts(f.inventory, f.inventory_after, f.product, AS_OF_TS)


@query("movement_alerts")
def _a1b(f: Fixtures):
    return rules.movement_alerts(f.stock_movements, f.inventory, f.product)


@query("customer_change_audit")
def _a2(f: Fixtures):
    return rules.customer_change_audit(f.customer, f.customer_after, AS_OF_TS, OPERATOR)


@query("product_review_count")
def _a3(f: Fixtures):
    return rules.product_review_count(f.product, f.order_item)


@query("negative_inventory_guard")
def _a4(f: Fixtures):
    return rules.negative_inventory_violations(f.inventory_minus5, AS_OF_TS)


@query("negative_inventory_guard_applied")
def _a4b(f: Fixtures):
    return rules.negative_inventory_guard(f.inventory, f.inventory_minus5)


def _guarded(f: Fixtures):
    return rules.guarded_updates(f.inventory, f.stock_movements.withColumnRenamed("event_id", "update_id"))


@query("guarded_inventory_updates")
def _a4c(f: Fixtures):
    """A4 over a sequence: every stock movement proposed in its order."""
    return _guarded(f)


@query("refused_inventory_updates")
def _a4d(f: Fixtures):
    return rules.refused_updates(_guarded(f))


# ------------------------------------------------------------------ X ----


@query("stream_low_stock_alerts")
def _x1(f: Fixtures):
    """Movements derived from events, delivered as 5-day slices out of
    order (watermark 11 days >= two slices); equals ``movement_alerts``."""
    spark = f.spark
    moves = f.stock_movements
    path = scratch_path(spark, "feeds/movements-" + _uuid())
    files = feeds.write_sliced_feed(moves, path, "ts", 5 * DAY, marker={"event_id": -1, "product_id": -1, "quantity_change": 0})
    return jobs.run_low_stock_alerts(
        spark, path, moves.schema, f.inventory, f.product, watermark="11 days", late_path=path + "-late", files_per_trigger=files)


@query("stream_customer_audit")
def _x2(f: Fixtures):
    """Two versions of every customer row (before at as_of - 1 day,
    after at as_of), the later file first; equals ``customer_change_audit``."""
    spark = f.spark
    before = f.customer.withColumn("version_ts", ts_lit(AS_OF_TS - _dt.timedelta(days=1)))
    after = f.customer_after.withColumn("version_ts", ts_lit(AS_OF_TS))
    versions = before.unionByName(after)
    path = scratch_path(spark, "feeds/customers-" + _uuid())
    files = feeds.write_sliced_feed(versions, path, "version_ts", DAY, marker={"customer_id": -1})
    return jobs.run_customer_audit(
        spark, path, versions.schema, OPERATOR, watermark="2 days", late_path=path + "-late", files_per_trigger=files)


@query("stream_customer_audit_late")
def _x2b(f: Fixtures):
    """The late table of X2: a third version of every customer that arrives
    after the watermark has passed it."""
    spark = f.spark
    versions = [
        f.customer.withColumn("version_ts", ts_lit(AS_OF_TS - _dt.timedelta(days=1))),
        f.customer_after.withColumn("version_ts", ts_lit(AS_OF_TS)),
        f.customer_after.withColumn("version_ts", ts_lit(AS_OF_TS + _dt.timedelta(days=9))),
        f.customer.withColumn("version_ts", ts_lit(AS_OF_TS + _dt.timedelta(days=2))),
    ]
    path = scratch_path(spark, "feeds/customers-" + _uuid())
    rows = versions[0].unionByName(versions[1]).unionByName(versions[2]).unionByName(versions[3])
    files = feeds.write_sliced_feed(rows, path, "version_ts", DAY, marker={"customer_id": -1}, order=[0, 1, 10, 3])
    jobs.run_customer_audit(
        spark, path, rows.schema, OPERATOR, watermark="2 days", late_path=path + "-late", files_per_trigger=files)
    return spark.read.parquet(path + "-late")


@query("stream_lifetime_value")
def _x3(f: Fixtures):
    """Two versions of every order, as accepted and with its final status
    some days later, as yearly slices out of order, the versions of every 13th
    order delivered twice; equals the lifetime value of the final orders."""
    spark = f.spark
    path = scratch_path(spark, "feeds/orders-" + _uuid())
    versions = f.order_versions
    files = feeds.write_sliced_feed(
        versions, path, "version_ts", 365 * DAY, marker={"order_id": -1, "customer_id": -1}, duplicate_every=[("order_id", 13)],
    )
    return jobs.run_lifetime_value(spark, path, versions.schema, files_per_trigger=files, compact_every=3)


def _uuid() -> str:
    return uuid.uuid4().hex



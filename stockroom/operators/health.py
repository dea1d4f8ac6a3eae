"""Inventory health, integrity and monitoring reports.

Correlated subqueries of the reference become one pre-aggregate per product
joined once; integrity counts are anti/semi joins with a global count (the
only single-partition step is the final one-row aggregate).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockroom.functions.joins import broadcast_if_small
from stockroom.functions.money import lit_dec, round_ratio

EXCLUDED = ("Cancelled", "Returned")
EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"


def _int_div(a: Column, b: Column) -> Column:
    """floor(a / b) for non-negative a and positive b, exact."""
    return ((a - F.pmod(a, b)) / b).cast("long")


def _categories(product_category: DataFrame) -> DataFrame:
    """The category catalogue, broadcast behind a row count: category ids
    have few values, so a join keyed by them would put every product of the
    largest category in one task."""
    return broadcast_if_small(product_category.select("category_id", "category_name"))


def _since(as_of: dt.date, days: int) -> Column:
    return F.date_sub(F.lit(as_of), days)


def quantity_on_order(purchase_order_items: DataFrame, purchase_orders: DataFrame) -> DataFrame:
    """Open ordered minus received per product (status Ordered/Partial)."""
    open_pos = purchase_orders.filter(F.col("status").isin("Ordered", "Partial")).select("po_id")
    return (
        purchase_order_items.join(open_pos, "po_id", "left_semi")
        .groupBy("product_id")
        .agg(
            F.sum(F.col("quantity_ordered") - F.col("quantity_received"))
            .cast("long")
            .alias("quantity_on_order")
        )
    )


def critical_stock(
    product: DataFrame,
    product_category: DataFrame,
    inventory: DataFrame,
    order_item: DataFrame,
    orders: DataFrame,
    purchase_orders: DataFrame,
    purchase_order_items: DataFrame,
    as_of: dt.date,
    window_days: int = 30,
) -> DataFrame:
    """H1: active products with available <= 2 x reorder point.

    The three identical correlated AVG subqueries are one (sum, count)
    pre-aggregate over the recent lines (any order status, as coded).
    """
    recent_orders = orders.filter(F.col("order_date") >= _since(as_of, window_days)).select("order_id")
    recent = (
        order_item.select("order_id", "product_id", "quantity")
        .join(recent_orders, "order_id", "left_semi")
        .groupBy("product_id")
        .agg(F.sum("quantity").cast("long").alias("_q"), F.count("quantity").alias("_n"))
    )
    on_order = quantity_on_order(purchase_order_items, purchase_orders)
    base = (
        product.filter(F.col("is_active"))
        .select("product_id", "product_name", "sku", "category_id")
        .join(inventory, "product_id")
        .filter(F.col("quantity_available") <= F.col("reorder_point") * 2)
        .join(_categories(product_category), "category_id")
    )
    j = base.join(on_order, "product_id", "left").join(recent, "product_id", "left")
    avail, rp = F.col("quantity_available"), F.col("reorder_point")
    avg_sales = F.coalesce(F.col("_q").cast("double") / F.col("_n").cast("double"), F.lit(0.0))
    return j.select(
        F.lit("CRITICAL_STOCK").alias("analysis_type"),
        "product_id",
        "product_name",
        "sku",
        "category_name",
        "quantity_on_hand",
        "quantity_available",
        "reorder_point",
        "reorder_quantity",
        F.when(avail <= 0, "OUT_OF_STOCK")
        .when(avail <= rp, "BELOW_REORDER")
        .when(avail <= rp * 2, "LOW_STOCK")
        .otherwise("HEALTHY")
        .alias("stock_status"),
        F.datediff(F.lit(as_of), F.col("last_restock_date")).alias("days_since_restock"),
        F.coalesce(F.col("quantity_on_order"), F.lit(0)).cast("long").alias("quantity_on_order"),
        avg_sales.alias("avg_daily_sales"),
        F.when(avail <= 0, F.lit(0).cast("long"))
        .when(F.coalesce(F.col("_q"), F.lit(0)) == 0, F.lit(999).cast("long"))
        .otherwise(_int_div(avail.cast("long") * F.col("_n"), F.col("_q")))
        .alias("days_of_inventory"),
    ).orderBy("quantity_available", "product_id")


def slow_moving_inventory(
    product: DataFrame,
    product_category: DataFrame,
    inventory: DataFrame,
    order_item: DataFrame,
    orders: DataFrame,
    as_of: dt.date,
    days: int = 90,
    literal: bool = False,
) -> DataFrame:
    """Active stocked products without recent sales.

    H2 sums only lines of kept orders in the last ``days`` (documented
    intent); H2b (``literal=True``) sums every line of the product, as the
    reference's join is written. ``inventory`` must carry last_sale_date.
    """
    lines = order_item.select("order_id", "product_id", "quantity")
    if not literal:
        recent = orders.filter(
            (F.col("order_date") >= _since(as_of, days)) & ~F.col("order_status").isin(*EXCLUDED)
        ).select("order_id")
        lines = lines.join(recent, "order_id", "left_semi")
    sales = lines.groupBy("product_id").agg(F.sum("quantity").cast("long").alias("_sold"))
    base = (
        product.filter(F.col("is_active"))
        .select("product_id", "product_name", "sku", "category_id")
        .join(inventory.filter(F.col("quantity_on_hand") > 0), "product_id")
        .join(_categories(product_category), "category_id")
    )
    j = base.join(sales, "product_id", "left")
    sold = F.coalesce(F.col("_sold"), F.lit(0)).cast("long")
    since = F.datediff(F.lit(as_of), F.col("last_sale_date"))
    out = j.select(
        F.lit("SLOW_MOVING").alias("analysis_type"),
        "product_id",
        "product_name",
        "sku",
        "category_name",
        "quantity_on_hand",
        "quantity_available",
        sold.alias("last_90_days_sales"),
        "last_sale_date",
        since.alias("days_since_last_sale"),
        round_ratio(F.col("quantity_on_hand"), sold).alias("months_of_supply"),
    )
    return out.filter(
        (F.col("last_90_days_sales") == 0) | (F.col("days_since_last_sale") > days)
    ).orderBy(F.col("days_since_last_sale").desc(), F.col("product_id"))


# ---------------------------------------------------------- integrity ----
def _issue(df: DataFrame, issue: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("count")).select(F.lit(issue).alias("issue_type"), "count")


def orphaned_order_items(order_item: DataFrame, orders: DataFrame) -> DataFrame:
    """H3: lines whose order does not exist."""
    return _issue(
        order_item.select("order_id").join(orders.select("order_id"), "order_id", "left_anti"),
        "ORPHANED_ORDER_ITEMS",
    )


def orphaned_inventory(inventory: DataFrame, product: DataFrame) -> DataFrame:
    """H4: stock rows whose product does not exist."""
    return _issue(
        inventory.select("product_id").join(product.select("product_id"), "product_id", "left_anti"),
        "ORPHANED_INVENTORY",
    )


def negative_inventory(inventory: DataFrame) -> DataFrame:
    """H5: on hand or reserved below zero."""
    return _issue(
        inventory.filter((F.col("quantity_on_hand") < 0) | (F.col("quantity_reserved") < 0)),
        "NEGATIVE_INVENTORY",
    )


def inactive_products_with_stock(product: DataFrame, inventory: DataFrame) -> DataFrame:
    """H6: inactive products that still hold or reserve stock."""
    stocked = inventory.filter((F.col("quantity_on_hand") > 0) | (F.col("quantity_reserved") > 0))
    return _issue(
        product.filter(~F.col("is_active")).select("product_id").join(
            stocked.select("product_id"), "product_id"
        ),
        "INACTIVE_PRODUCTS_WITH_STOCK",
    )


def invalid_customer_emails(customer: DataFrame) -> DataFrame:
    """H7: e-mails failing the declared pattern."""
    return _issue(customer.filter(~F.col("email").rlike(EMAIL_PATTERN)), "INVALID_CUSTOMER_EMAILS")


def orders_total_mismatch(orders: DataFrame, order_item: DataFrame) -> DataFrame:
    """H8: |total - sum(lines)| > 0.01, as coded (tax and shipping count as
    a mismatch; orders without lines are not checked)."""
    lines = order_item.groupBy("order_id").agg(
        F.sum(F.col("quantity") * F.col("unit_price")).alias("calculated_total")
    )
    return _issue(
        orders.select("order_id", "total_amount")
        .join(lines, "order_id")
        .filter(F.abs(F.col("total_amount") - F.col("calculated_total")) > lit_dec("0.01")),
        "ORDERS_TOTAL_MISMATCH",
    )


def orders_total_mismatch_components(orders: DataFrame, order_item: DataFrame) -> DataFrame:
    """Total vs its components, and subtotal vs the lines."""
    lines = order_item.groupBy("order_id").agg(
        F.sum(F.col("quantity") * F.col("unit_price")).alias("calculated_total")
    )
    total_off = F.col("total_amount") != (
        F.col("subtotal") + F.col("tax_amount") + F.col("shipping_amount") - F.col("discount_amount")
    )
    lines_off = F.abs(F.col("subtotal") - F.coalesce(F.col("calculated_total"), F.lit(0))) > lit_dec("0.01")
    return _issue(
        orders.join(lines, "order_id", "left").filter(total_off | lines_off),
        "ORDERS_COMPONENT_MISMATCH",
    )


def data_integrity_report(parts: Iterable[DataFrame]) -> DataFrame:
    """H9: the integrity checks as one long (issue_type, count) table."""
    parts = list(parts)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --------------------------------------------------------- monitoring ----
def unresolved_errors_by_severity(system_error_log: DataFrame) -> DataFrame:
    """Count, first and last unresolved error per severity."""
    return (
        system_error_log.filter(~F.col("resolved"))
        .groupBy("severity")
        .agg(
            F.count(F.lit(1)).alias("error_count"),
            F.min("error_time").alias("oldest_error"),
            F.max("error_time").alias("latest_error"),
        )
        .select(F.lit("UNRESOLVED_ERRORS").alias("check_type"), "error_count", "severity",
                "oldest_error", "latest_error")
    )


def active_alerts_by_level(low_stock_alerts: DataFrame) -> DataFrame:
    """Count, first and last open alert per level."""
    return (
        low_stock_alerts.filter(~F.col("resolved"))
        .groupBy("alert_level")
        .agg(
            F.count(F.lit(1)).alias("alert_count"),
            F.min("alert_date").alias("oldest_alert"),
            F.max("alert_date").alias("latest_alert"),
        )
        .select(F.lit("ACTIVE_ALERTS").alias("check_type"), "alert_count", "alert_level",
                "oldest_alert", "latest_alert")
    )


def system_status(
    orders: DataFrame,
    low_stock_alerts: DataFrame,
    system_error_log: DataFrame,
    active_connections_log: DataFrame,
) -> DataFrame:
    """One status row.

    The five scalar subqueries become one aggregate over a tagged union, so
    each source is scanned once and nothing is cross-joined.
    """
    n = F.lit(None)
    tagged = (
        orders.select(
            F.lit(1).alias("_src"), (F.col("order_status") == "Pending").alias("_hit"),
            F.col("order_date").alias("_ts"),
        )
        .unionByName(
            low_stock_alerts.select(
                F.lit(2).alias("_src"),
                (~F.col("resolved") & (F.col("alert_level") == "CRITICAL")).alias("_hit"),
                n.cast("timestamp_ntz").alias("_ts"),
            )
        )
        .unionByName(
            system_error_log.select(
                F.lit(3).alias("_src"),
                (~F.col("resolved") & (F.col("severity") == "HIGH")).alias("_hit"),
                n.cast("timestamp_ntz").alias("_ts"),
            )
        )
        .unionByName(
            active_connections_log.select(
                F.lit(4).alias("_src"), F.lit(True).alias("_hit"), n.cast("timestamp_ntz").alias("_ts")
            )
        )
    )

    def cnt(src: int) -> Column:
        return F.count(F.when((F.col("_src") == src) & F.col("_hit"), F.lit(1)))

    return tagged.agg(
        cnt(1).alias("pending_orders"),
        cnt(2).alias("critical_alerts"),
        cnt(3).alias("high_errors"),
        F.max(F.when(F.col("_src") == 1, F.col("_ts"))).alias("last_order_time"),
        cnt(4).alias("active_connections_logs"),
    ).select(F.lit("SYSTEM_STATUS").alias("report"), "*")


def recent_errors(system_error_log: DataFrame, n: int = 10) -> DataFrame:
    """The n latest unresolved errors (id breaks ties)."""
    return (
        system_error_log.filter(~F.col("resolved"))
        .select("error_id", "error_time", "error_code", "error_message", "severity", "stored_procedure")
        .orderBy(F.col("error_time").desc(), F.col("error_id").desc())
        .limit(n)
    )


def slow_queries(query_performance_log: DataFrame, threshold_ms: int = 1000, n: int = 10) -> DataFrame:
    """The n slowest logged queries above the threshold."""
    return (
        query_performance_log.filter(F.col("execution_time_ms") > threshold_ms)
        .select("query_id", "log_time", "query_type", "execution_time_ms", "rows_affected", "query_text")
        .orderBy(F.col("execution_time_ms").desc(), F.col("query_id").asc())
        .limit(n)
    )


def log_retention(log: DataFrame, ts_col: str, as_of: dt.date, days: int) -> DataFrame:
    """Rows kept after deleting those older than ``as_of - days``.

    On a log partitioned by day the predicate prunes whole partitions.
    """
    cutoff = F.date_sub(F.lit(as_of), days).cast("timestamp_ntz")
    return log.filter((F.col(ts_col) >= cutoff) | F.col(ts_col).isNull())


def stock_position(inventory: DataFrame, product: DataFrame, product_ids: Iterable[int]) -> DataFrame:
    """Name, on hand and reserved for a list of products."""
    ids = list(product_ids)
    return (
        inventory.filter(F.col("product_id").isin(ids))
        .select("product_id", "quantity_on_hand", "quantity_reserved")
        .join(product.filter(F.col("product_id").isin(ids)).select("product_id", "product_name"), "product_id")
        .select("product_id", "product_name", "quantity_on_hand", "quantity_reserved")
    )


def movements_by_reference(
    inventory_log: DataFrame, reference_id: int, reference_table: str | None = None, n: int = 5
) -> DataFrame:
    """The latest n ledger rows of one reference."""
    cond = F.col("reference_id") == reference_id
    if reference_table is not None:
        cond = cond & (F.col("reference_table") == reference_table)
    return inventory_log.filter(cond).orderBy(F.col("log_id").desc()).limit(n)


def entity_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per entity, one row each."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("entity"), "row_count")
        for name, df in frames.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out

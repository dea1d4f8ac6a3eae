"""Sales KPIs and analytics (K1-K7).

Plans: filters are applied to the fact before the join so they reach the
Parquet scan; dimensions are joined after aggregation where the result is
keyed by the dimension; AQE picks broadcast vs sort-merge from runtime sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockroom.functions.joins import broadcast_if_small
from stockroom.functions.money import mean, money_sum
from stockroom.functions.windows import bucket_mode, previous_value, rank_descending

EXCLUDED = ("Cancelled", "Returned")
COMPLETED = ("Shipped", "Delivered")


def _kept(orders: DataFrame) -> DataFrame:
    return orders.filter(~F.col("order_status").isin(*EXCLUDED))


def customer_sales_summary(
    customer: DataFrame, orders: DataFrame, order_id_is_key: bool = True
) -> DataFrame:
    """K1: per customer (also those without orders) spend, count, mean, last date.

    The status test belongs to the join, not to a WHERE: customers whose
    orders are all cancelled still appear with zeros. Orders are aggregated
    per customer first (partial aggregation, one shuffle on customer_id),
    then joined 1:1 to the customers. ``order_id`` is the primary key of
    orders, so COUNT(DISTINCT order_id) is COUNT(order_id) here and needs no
    second shuffle; pass ``order_id_is_key=False`` for data where it is not.
    """
    per_customer = (
        _kept(orders)
        .groupBy("customer_id")
        .agg(
            F.sum("total_amount").alias("_sum"),
            F.count("total_amount").alias("_n_amount"),
            (F.count("order_id") if order_id_is_key else F.countDistinct("order_id")).alias("total_orders"),
            F.max("order_date").alias("last_order_date"),
        )
    )
    joined = customer.select("customer_id", "full_name", "email").join(
        per_customer, "customer_id", "left"
    )
    return joined.select(
        "customer_id",
        "full_name",
        "email",
        F.coalesce(F.col("_sum"), F.lit(0)).cast("decimal(18,2)").alias("total_spent"),
        F.coalesce(F.col("total_orders"), F.lit(0)).cast("long").alias("total_orders"),
        mean(F.col("_sum"), F.col("_n_amount")).alias("avg_order_value"),
        F.col("last_order_date"),
    )


def total_revenue(orders: DataFrame) -> DataFrame:
    """K2: one row, revenue of shipped and delivered orders (NULL if none)."""
    return (
        orders.filter(F.col("order_status").isin(*COMPLETED))
        .agg(money_sum(F.col("total_amount")).alias("Value"))
        .select(F.lit("Total Revenue").alias("KPI"), "Value")
    )


def top_customers(summary: DataFrame, n: int = 10) -> DataFrame:
    """K3: top-n customers by spend (ties broken by id for determinism)."""
    return (
        summary.select("customer_id", "full_name", "total_spent")
        .orderBy(F.col("total_spent").desc(), F.col("customer_id").asc())
        .limit(n)
    )


def best_selling_products(
    order_item: DataFrame,
    product: DataFrame,
    orders: DataFrame,
    n: int = 5,
    exclude_status: bool = True,
) -> DataFrame:
    """Top-n products by units sold.

    Lines are semi-joined to the kept orders, summed per product (partial
    aggregation before the shuffle), and only then joined to the product
    dimension, so the dimension join sees one row per product.
    """
    kept = _kept(orders) if exclude_status else orders
    lines = order_item.select("order_id", "product_id", "quantity").join(
        kept.select("order_id"), "order_id", "left_semi"
    )
    sold = lines.groupBy("product_id").agg(F.sum("quantity").cast("long").alias("total_sold"))
    named = sold.join(product.select("product_id", "product_name"), "product_id")
    return named.orderBy(F.col("total_sold").desc(), F.col("product_id").asc()).limit(n).select(
        "product_id", "product_name", "total_sold"
    )


def monthly_sales_trend(orders: DataFrame) -> DataFrame:
    """K5: order count and revenue per yyyy-MM of kept orders."""
    return (
        _kept(orders)
        .groupBy(F.date_format("order_date", "yyyy-MM").alias("sales_month"))
        .agg(
            F.count("order_id").alias("total_orders"),
            money_sum(F.col("total_amount")).alias("revenue"),
        )
        .orderBy("sales_month")
    )


def category_sales_rank(
    order_item: DataFrame, product: DataFrame, product_category: DataFrame, orders: DataFrame, bucket: str | None = None
) -> DataFrame:
    """K6: revenue per (category, product name) and its rank in the category.

    Groups by product *name* as the reference does (names may repeat). Line
    revenue is first summed per product, so the fact side shrinks before the
    dimension joins. A category with very many products is ranked over range
    buckets of its revenues (``rank_descending``), not in one task.
    """
    lines = order_item.select(
        "order_id", "product_id", (F.col("quantity") * F.col("unit_price")).alias("_rev")
    ).join(_kept(orders).select("order_id"), "order_id", "left_semi")
    per_product = lines.groupBy("product_id").agg(F.sum("_rev").alias("_rev"))
    named = per_product.join(
        product.select("product_id", "product_name", "category_id"), "product_id"
    ).join(
        # few category ids: broadcast the (size-checked) catalogue instead of
        # shuffling products by category
        broadcast_if_small(product_category.select("category_id", "category_name")), "category_id"
    )
    grouped = named.groupBy("category_name", "product_name").agg(
        money_sum(F.col("_rev")).alias("product_revenue")
    )
    # a category has at most as many rows as products: size it there
    return rank_descending(
        grouped, ["category_name"], "product_revenue", "rank_in_category", bucket or bucket_mode(product, ["category_id"]),
    ).select("category_name", "product_name", "product_revenue", "rank_in_category")


def customer_order_frequency(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """K7: previous order date and day gap per customer.

    ``order_id`` breaks ties between same-day orders. If one customer holds
    more than a bounded number of orders, the lag is computed two-level
    (customer, range bucket), so that customer is not one task.
    """
    base = orders.select("order_id", "customer_id", "order_date").join(
        customer.select("customer_id", "full_name"), "customer_id"
    )
    lagged = previous_value(
        base,
        keys=["customer_id"],
        order=["order_date", "order_id"],
        value="order_date",
        out="previous_order_date",
        # the customer join is 1:1 and only drops rows: size the key on orders
        bucket=bucket_mode(orders, ["customer_id"]),
    )
    return lagged.select(
        "full_name",
        "order_id",
        "order_date",
        "previous_order_date",
        F.datediff(F.col("order_date"), F.col("previous_order_date")).alias("days_since_last_order"),
    )

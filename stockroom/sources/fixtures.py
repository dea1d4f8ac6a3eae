"""Model-shaped views over the driver tables (see FIXTURES.md section 3).

The driver data is TPC-H shaped; these views give it the shape of the
order/inventory model: orders, order items, products, stock, customers,
promotions and request batches. The same definitions exist as DuckDB SQL in
``stockroom.plans.oracle`` so both engines see equal inputs.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockroom.functions.ids import LINES_PER_ID
from stockroom.sources.tables import read_table

# Fixed report dates: every operator takes ``as_of`` instead of a clock.
REPORT_DATE = dt.date(2001, 8, 1)
LOG_DATE = dt.date(2024, 1, 30)
OPERATOR = "batch@stockroom"
AMPLE_STOCK = 100000
SECOND_RETURN = 1_000_000_000_000
INT_MAX = 2**31 - 1


def money(c: Column | str, precision: int = 10) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return col.cast(T.DecimalType(precision, 2))


def _status(o: DataFrame) -> Column:
    key = F.col("o_orderkey")
    return (
        F.when(key % 20 == 0, "Cancelled")
        .when(key % 20 == 1, "Returned")
        .when(F.col("o_orderstatus") == "F", "Delivered")
        .when(F.col("o_orderstatus") == "O", "Shipped")
        .otherwise("Pending")
    )


class Fixtures:
    """Lazily built views for one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    # ---- dimensions -------------------------------------------------------
    @cached_property
    def product(self) -> DataFrame:
        p = self.table("part")
        return p.select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category_id"),
            F.concat(F.col("p_brand"), F.lit("-"), F.col("p_partkey").cast("string")).alias("sku"),
            money("p_retailprice").alias("price"),
            (F.col("p_partkey") % 50 != 0).alias("is_active"),
        )

    @cached_property
    def product_category(self) -> DataFrame:
        return (
            self.table("part")
            .select(F.col("p_type").alias("category_id"))
            .distinct()
            .withColumn("category_name", F.col("category_id"))
        )

    @cached_property
    def inventory(self) -> DataFrame:
        p = self.table("part")
        key = F.col("p_partkey")
        on_hand = ((key * 37) % 211).cast("int")
        reserved = ((key * 13) % 29).cast("int")
        return p.select(
            key.alias("product_id"),
            on_hand.alias("quantity_on_hand"),
            reserved.alias("quantity_reserved"),
            (on_hand - reserved).cast("int").alias("quantity_available"),
            (F.lit(10) + F.col("p_size") % 30).cast("int").alias("reorder_point"),
            (F.lit(20) + F.col("p_size")).cast("int").alias("reorder_quantity"),
            F.when(key % 11 == 0, F.lit(None).cast("date"))
            .otherwise(F.date_sub(F.lit(REPORT_DATE), (key % 200).cast("int")))
            .alias("last_restock_date"),
        )

    @cached_property
    def inventory_ample(self) -> DataFrame:
        """Stock raised by AMPLE_STOCK: every valid order fits."""
        return self.inventory.withColumns(
            {
                "quantity_on_hand": (F.col("quantity_on_hand") + AMPLE_STOCK).cast("int"),
                "quantity_available": (F.col("quantity_available") + AMPLE_STOCK).cast("int"),
            }
        )

    @cached_property
    def customer(self) -> DataFrame:
        c = self.table("customer")
        key = F.col("c_custkey")
        return c.select(
            key.alias("customer_id"),
            F.col("c_name").alias("full_name"),
            F.when(key % 17 == 0, F.lit("bad-email"))
            .otherwise(F.concat(F.lit("c"), key.cast("string"), F.lit("@example.com")))
            .alias("email"),
            (key % 25 != 0).alias("is_active"),
        )

    @cached_property
    def suppliers(self) -> DataFrame:
        s = self.table("supplier")
        return s.select(
            F.col("s_suppkey").alias("supplier_id"),
            F.col("s_name").alias("supplier_name"),
            (F.col("s_suppkey") % 10 != 0).alias("is_active"),
        )

    @cached_property
    def customer_loyalty(self) -> DataFrame:
        c = self.table("customer")
        key = F.col("c_custkey")
        return c.select(
            key.alias("customer_id"),
            F.col("c_acctbal").cast(T.DecimalType(12, 2)).alias("total_spent"),
            (key % 500).cast("int").alias("loyalty_points"),
            F.when(key % 4 == 0, "Bronze")
            .when(key % 4 == 1, "Silver")
            .when(key % 4 == 2, "Gold")
            .otherwise("Platinum")
            .alias("loyalty_tier"),
        )

    @cached_property
    def promotions(self) -> DataFrame:
        d = lambda v: None if v is None else Decimal(v)
        ts = lambda s: dt.datetime.fromisoformat(s)
        rows = [
            (1, "SPRING12", "Percentage", d("12"), d("40"), None, ts("1995-01-01"), ts("2001-12-31"), None, 0, True),
            (2, "PARCEL0", "Free Shipping", d("0"), d("250"), None, ts("1995-01-01"), ts("2001-12-31"), None, 0, True),
            (3, "MINUS75", "Fixed Amount", d("75"), d("900"), None, ts("1998-01-01"), ts("1998-12-31"), None, 0, True),
            (4, "CAPPED", "Percentage", d("20"), d("0"), d("500"), ts("1995-01-01"), ts("2001-12-31"), 50, 10, True),
            (5, "RETIRED", "Percentage", d("90"), d("0"), None, ts("1995-01-01"), ts("2001-12-31"), None, 0, False),
        ]
        dec = T.DecimalType(10, 2)
        schema = T.StructType(
            [
                T.StructField("promotion_id", T.IntegerType()),
                T.StructField("promotion_code", T.StringType()),
                T.StructField("promotion_type", T.StringType()),
                T.StructField("discount_value", dec),
                T.StructField("minimum_order_amount", dec),
                T.StructField("maximum_discount_amount", dec),
                T.StructField("valid_from", T.TimestampNTZType()),
                T.StructField("valid_to", T.TimestampNTZType()),
                T.StructField("max_uses_total", T.IntegerType()),
                T.StructField("times_used", T.IntegerType()),
                T.StructField("is_active", T.BooleanType()),
            ]
        )
        return self.spark.createDataFrame(rows, schema)

    # ---- facts ------------------------------------------------------------
    @cached_property
    def orders(self) -> DataFrame:
        o = self.table("orders")
        return o.select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").alias("order_date"),
            money("o_totalprice").alias("total_amount"),
            _status(o).alias("order_status"),
        )

    @cached_property
    def order_versions(self) -> DataFrame:
        """Every order as accepted (Processing) and, one to nine days later,
        with its final status."""
        final = self.orders.withColumn("version_ts", F.col("order_date") + F.make_dt_interval((F.col("order_id") % 9 + 1).cast("int")))
        first = self.orders.withColumns({"order_status": F.lit("Processing"), "version_ts": F.col("order_date")})
        return first.unionByName(final)

    @cached_property
    def order_item(self) -> DataFrame:
        # the key gets its name first, so that a grouping by order after the
        # window finds the rows in place
        li = self.table("lineitem").withColumnRenamed("l_orderkey", "order_id")
        w = Window.partitionBy("order_id").orderBy(
            "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"
        )
        return li.withColumn("_line", F.row_number().over(w)).select(
            (F.col("order_id") * LINES_PER_ID + F.col("_line")).alias("order_item_id"),
            "order_id",
            F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
            money("l_extendedprice").alias("unit_price"),
        )

    @cached_property
    def inventory_with_last_sale(self) -> DataFrame:
        """Inventory plus ``last_sale_date`` = latest order time of the product."""
        last = (
            self.order_item.join(self.orders, "order_id")
            .groupBy("product_id")
            .agg(F.max("order_date").alias("last_sale_date"))
        )
        return self.inventory.join(last, "product_id", "left")

    # ---- request batches --------------------------------------------------
    @cached_property
    def order_request_items(self) -> DataFrame:
        li = self.table("lineitem")
        k, n = F.col("l_orderkey"), F.col("l_linenumber")
        return li.select(
            k.alias("request_id"),
            F.when((k + n) % 97 == 0, F.lit(None).cast("long"))
            .when(k % 83 == 0, F.lit(-7).cast("long"))
            .otherwise(F.col("l_partkey"))
            .alias("product_id"),
            F.when((k + n) % 89 == 0, F.lit(0))
            .when((k * 7 + n) % 499 == 0, F.lit(INT_MAX))  # must not stop the batch
            .otherwise(F.col("l_quantity").cast("int"))
            .alias("quantity"),
        )

    @cached_property
    def order_requests(self) -> DataFrame:
        """One row per request; items travel as a JSON array string."""
        items = self.order_request_items.groupBy("request_id").agg(
            F.to_json(
                F.collect_list(F.struct("product_id", "quantity"))
            ).alias("items_json")
        )
        return self.order_request_heads.join(items, "request_id", "left")

    @cached_property
    def order_request_heads(self) -> DataFrame:
        o = self.table("orders")
        k = F.col("o_orderkey")
        return o.select(
            k.alias("request_id"),
            F.col("o_orderdate").alias("request_ts"),
            F.when(k % 41 == 0, F.lit(-1).cast("long")).otherwise(F.col("o_custkey")).alias("customer_id"),
            F.lit("Credit Card").alias("payment_method"),
            F.when(k % 5 == 0, "STANDARD")
            .when(k % 5 == 1, "EXPRESS")
            .when(k % 5 == 2, "OVERNIGHT")
            .when(k % 5 == 3, "PICKUP")
            .otherwise("standard")
            .alias("shipping_method"),
            F.lit('{"city": "Springfield"}').alias("shipping_address"),
            F.when(k % 7 == 0, "SPRING12")
            .when(k % 7 == 1, "parcel0")
            .when(k % 7 == 2, "MINUS75")
            .when(k % 7 == 3, "CAPPED")
            .when(k % 7 == 4, "RETIRED")
            .when(k % 7 == 5, "UNKNOWN")
            .otherwise(F.lit(None).cast("string"))
            .alias("promotion_code"),
        )

    @cached_property
    def restocks(self) -> DataFrame:
        oi = self.order_item
        rid = F.col("order_item_id")
        return oi.select(
            rid.alias("restock_id"),
            F.col("product_id"),
            # every third line of some products, and single lines of others,
            # bring their stock up to the largest INT and beyond
            F.when(rid % 53 == 0, F.lit(0))
            .when((F.col("product_id") % 100 == 7) & (rid % 3 == 0), F.lit(2**29))
            .when(rid % 1009 == 0, F.lit(INT_MAX))
            .otherwise(F.col("quantity"))
            .alias("quantity"),
            F.when(rid % 3 == 0, F.lit(None).cast("string"))
            .otherwise(F.concat(F.lit("B"), rid.cast("string")))
            .alias("batch_number"),
            F.when(rid % 7 == 0, F.lit(None).cast("long"))
            .otherwise(F.col("product_id") % 110)
            .alias("supplier_id"),
            money("unit_price").alias("unit_cost"),
        )

    @cached_property
    def return_request_items(self) -> DataFrame:
        i = self.order_item.withColumn("request_id", F.col("order_id"))
        # a second request for every fifth order: only one of the two can pass
        again = i.filter(F.col("order_id") % 5 == 0).withColumn("request_id", F.col("order_id") + SECOND_RETURN)
        return self._returned_items(i.unionByName(again), "request_id")

    @staticmethod
    def _returned_items(items: DataFrame, *keys: str) -> DataFrame:
        return items.select(
            *keys,
            F.col("order_id"),
            F.col("order_item_id"),
            F.when(F.col("order_id") % 31 == 0, F.col("quantity") + 1)
            .otherwise(F.col("quantity"))
            .alias("quantity"),
            F.when(F.col("order_item_id") % 3 == 0, "New")
            .when(F.col("order_item_id") % 3 == 1, "Opened")
            .otherwise("Damaged")
            .alias("conditions"),
        )

    @cached_property
    def return_requests(self) -> DataFrame:
        """One row per return request with its items as JSON: those of
        ``return_request_items``, built once per order and given to each of
        the order's requests."""
        again = F.when(F.col("order_id") % 5 == 0, F.array("order_id", F.col("order_id") + SECOND_RETURN))
        items = self._returned_items(self.order_item).groupBy("order_id").agg(
            F.to_json(
                F.collect_list(
                    F.struct(
                        "order_item_id",
                        "quantity",
                        F.col("conditions").alias("condition"),
                    )
                )
            ).alias("items_json"),
        )
        return items.select(
            F.explode(F.coalesce(again, F.array("order_id"))).alias("request_id"),
            "order_id",
            "items_json",
            F.lit("Customer request").alias("return_reason"),
            F.lit("Original payment").alias("refund_method"),
        )

    @cached_property
    def purchase_orders(self) -> DataFrame:
        o = self.table("orders")
        k = F.col("o_orderkey")
        return o.select(
            k.alias("po_id"),
            F.when(k % 3 == 0, "Ordered").when(k % 3 == 1, "Partial").otherwise("Received").alias("status"),
        )

    @cached_property
    def purchase_order_items(self) -> DataFrame:
        li = self.table("lineitem")
        q = F.col("l_quantity").cast("int")
        return li.select(
            F.col("l_orderkey").alias("po_id"),
            F.col("l_partkey").alias("product_id"),
            q.alias("quantity_ordered"),
            F.least(q, F.col("l_linenumber")).alias("quantity_received"),
        )

    # ---- logs -------------------------------------------------------------
    @cached_property
    def low_stock_alerts(self) -> DataFrame:
        inv = self.inventory.filter(F.col("quantity_on_hand") <= F.col("reorder_point"))
        q, rp = F.col("quantity_on_hand"), F.col("reorder_point")
        return inv.select(
            F.col("product_id"),
            q.alias("current_quantity"),
            rp,
            F.when(q <= rp * F.lit(Decimal("0.2")), "CRITICAL")
            .when(q <= rp * F.lit(Decimal("0.45")), "WARNING")
            .otherwise("INFO")
            .alias("alert_level"),
            F.col("last_restock_date").alias("alert_date"),
            (F.col("product_id") % 2 == 0).alias("resolved"),
        )

    @cached_property
    def system_error_log(self) -> DataFrame:
        e = self.table("events").filter(F.col("event_type") == "error")
        k = F.col("event_id")
        return e.select(
            k.alias("error_id"),
            F.col("ts").alias("error_time"),
            F.concat(F.lit("E"), (k % 7).cast("string")).alias("error_code"),
            F.when(k % 4 == 0, "LOW").when(k % 4 == 1, "MEDIUM").when(k % 4 == 2, "HIGH")
            .otherwise("CRITICAL").alias("severity"),
            (k % 3 == 0).alias("resolved"),
            F.concat(F.lit("Event "), k.cast("string"), F.lit(" failed")).alias("error_message"),
            F.concat(F.lit("Job"), (k % 5).cast("string")).alias("stored_procedure"),
        )

    @cached_property
    def query_performance_log(self) -> DataFrame:
        e = self.table("events").filter(F.col("event_type").isin("view", "click"))
        return e.select(
            F.col("event_id").alias("query_id"),
            F.col("ts").alias("log_time"),
            F.col("event_type").alias("query_type"),
            F.floor(F.col("value") * 10).cast("int").alias("execution_time_ms"),
            (F.col("event_id") % 1000).alias("rows_affected"),
            F.concat(F.lit("query "), F.col("event_id").cast("string")).alias("query_text"),
        )

    @cached_property
    def active_connections_log(self) -> DataFrame:
        e = self.table("events").filter(F.col("event_type") == "signup")
        return e.select(F.col("event_id").alias("connection_id"), F.col("ts").alias("logged_at"))

    @cached_property
    def stock_movements(self) -> DataFrame:
        e = self.table("events").filter(F.col("event_type").isin("purchase", "signup"))
        mag = F.ceil(F.col("value") / 20).cast("int")
        return e.select(
            F.col("event_id"),
            F.col("ts"),
            F.regexp_extract("props", "([0-9]+)", 1).cast("int").alias("product_id"),
            F.when(F.col("event_type") == "purchase", -mag).otherwise(mag).alias("quantity_change"),
        )

    # ---- deliberately broken variants to exercise the checks ---------------
    @cached_property
    def order_item_broken(self) -> DataFrame:
        """All lines; those of every 97th order name an order that is not there."""
        key = F.col("order_id")
        return self.order_item.withColumn("order_id", F.when(key % 97 == 0, -key).otherwise(key))

    @cached_property
    def inventory_broken(self) -> DataFrame:
        """All stock rows; every 89th names a product that is not there."""
        key = F.col("product_id")
        return self.inventory.withColumn("product_id", F.when(key % 89 == 0, -key).otherwise(key))

    @cached_property
    def inventory_minus5(self) -> DataFrame:
        """Proposed stock levels 5 below the current ones (some negative)."""
        return self.inventory.withColumns(
            {
                "quantity_on_hand": (F.col("quantity_on_hand") - 5).cast("int"),
                "quantity_available": (F.col("quantity_on_hand") - 5 - F.col("quantity_reserved")).cast("int"),
            }
        )

    # ---- before/after pairs for change-driven rules ------------------------
    @cached_property
    def inventory_after(self) -> DataFrame:
        q = F.col("quantity_on_hand")
        lowered = F.when(F.col("product_id") % 2 == 0, F.greatest(q - 20, F.lit(0))).otherwise(q)
        return self.inventory.withColumn("quantity_on_hand", lowered.cast("int")).withColumn(
            "quantity_available", (F.col("quantity_on_hand") - F.col("quantity_reserved")).cast("int")
        )

    @cached_property
    def customer_after(self) -> DataFrame:
        return self.customer.withColumn(
            "email",
            F.when(
                F.col("customer_id") % 9 == 0,
                F.concat(F.lit("new."), F.col("customer_id").cast("string"), F.lit("@example.org")),
            ).otherwise(F.col("email")),
        )

    # ---- one reference graph for deletes (C7) -------------------------------
    @cached_property
    def shipping_info(self) -> DataFrame:
        """A shipment for every second order."""
        return self.orders.filter(F.col("order_id") % 2 == 0).select(F.col("order_id").alias("shipping_id"), "order_id")

    @cached_property
    def returns(self) -> DataFrame:
        """A return for every fourth order."""
        return self.orders.filter(F.col("order_id") % 4 == 0).select(
            (F.col("order_id") * 10).alias("return_id"), "order_id", "customer_id")

    @cached_property
    def return_items(self) -> DataFrame:
        items = self.order_item.filter(F.col("order_id") % 4 == 0)
        return items.select(F.col("order_item_id").alias("return_item_id"), (F.col("order_id") * 10).alias("return_id"), "product_id")

    @cached_property
    def delete_requests(self) -> DataFrame:
        """Requests to delete rows of four tables, some of which do not exist."""
        def some(rows: DataFrame, table: str, key: str, every: int) -> DataFrame:
            return rows.filter(F.col(key) % every == 0).select(F.lit(table).alias("table"), F.col(key).cast("long").alias("key"))

        customers = some(self.customer, "customer", "customer_id", 3)
        return (
            customers.unionByName(customers.select("table", (-F.col("key")).alias("key")))
            .unionByName(some(self.orders, "orders", "order_id", 11))
            .unionByName(some(self.returns, "returns", "order_id", 3).withColumn("key", F.col("key") * 10))
            .unionByName(some(self.product, "product", "product_id", 13))
        )

    # ---- tables that break each of their declared constraints (C1-C4) -------
    @cached_property
    def broken_tables(self) -> dict[str, DataFrame]:
        def spoilt(rows: DataFrame, key: str, **columns: tuple[int, Column]) -> DataFrame:
            """Column values replaced in the rows whose key is divisible."""
            return rows.withColumns({c: F.when(F.col(key) % every == 0, value).otherwise(F.col(c)) for c, (every, value) in columns.items()})

        def twice(rows: DataFrame, key: str, every: int) -> DataFrame:
            return rows.unionByName(rows.filter(F.col(key) % every == 0))

        c = F.col
        null = F.lit(None)
        again = self.product_category.filter(c("category_id").endswith("BRASS")).withColumn("category_id", F.concat("category_id", F.lit("-2")))
        return {
            "customer": twice(spoilt(self.customer, "customer_id", full_name=(103, null)), "customer_id", 101),
            "customer_loyalty": spoilt(
                self.customer_loyalty.withColumn("loyalty_id", c("customer_id")), "loyalty_id",
                customer_id=(107, -c("customer_id")), loyalty_tier=(109, F.lit("Diamond"))),
            "product_category": self.product_category.unionByName(again),
            "product": spoilt(self.product, "product_id", price=(113, -c("price")), sku=(127, F.lit("DUP")), category_id=(131, F.lit("NONE"))),
            "suppliers": spoilt(self.suppliers, "supplier_id", supplier_name=(7, null)),
            "inventory": spoilt(
                self.inventory_minus5.withColumn("inventory_id", c("product_id")), "inventory_id", product_id=(89, -c("product_id")),
                quantity_reserved=(79, F.lit(-1)), reorder_point=(83, F.lit(-1)), reorder_quantity=(97, F.lit(0))),
            "promotions": spoilt(self.promotions, "promotion_id", promotion_type=(5, F.lit("Coupon")), promotion_code=(5, F.lit("SPRING12"))),
            "orders": twice(spoilt(
                self.orders, "order_id", customer_id=(41, F.lit(-1)), total_amount=(43, -c("total_amount")), order_status=(47, F.lit("Lost"))),
                "order_id", 53),
            "order_item": spoilt(
                self.order_item_broken, "order_item_id", quantity=(59, F.lit(0)), unit_price=(61, -c("unit_price")), product_id=(67, -c("product_id"))),
            "low_stock_alerts": spoilt(
                self.low_stock_alerts.withColumn("alert_id", c("product_id")), "alert_id", alert_level=(71, F.lit("PANIC")), product_id=(2, -c("product_id"))),
            "system_error_log": spoilt(self.system_error_log, "error_id", severity=(73, F.lit("FATAL"))),
        }

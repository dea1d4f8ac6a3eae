"""Small made-up shop: rows for the golden cases."""

import datetime as dt
from decimal import Decimal as D

from pyspark.sql import types as T

NOW = dt.datetime(2025, 1, 15, 10, 0, 0)


def product(spark):
    rows = [
        (1, "Fern", 10, "PLT-F", D("18.25"), True),
        (2, "Olive Tree", 10, "PLT-O", D("880.00"), True),
        (3, "Clay Trough", 20, "POT-C", D("92.00"), True),
        (5, "Potting Soil", 30, "SOI-P", D("35.00"), True),
        (6, "Leaf Mould", 30, "SOI-L", D("21.40"), True),
        (14, "Pruning Saw", 40, "TOO-S", D("58.75"), False),
    ]
    return spark.createDataFrame(
        rows, "product_id long, product_name string, category_id int, sku string, price decimal(10,2), is_active boolean"
    )


def inventory(spark):
    rows = [(5, 170, 25, 90), (1, 44, 12, 24), (3, 90, 18, 40), (14, 8, 1, 4), (2, 6, 2, 3), (6, 70, 22, 45)]
    return spark.createDataFrame(
        [(p, q, 0, q, rp, rq, None) for p, q, rp, rq in rows],
        "product_id long, quantity_on_hand int, quantity_reserved int, quantity_available int, "
        "reorder_point int, reorder_quantity int, last_restock_date date",
    )


CUSTOMERS = {1: ("Mara Lind", True), 2: ("Otis Vega", True), 7: ("Ines Kord", False), 8: ("Tomas Brand", True)}


def customer(spark):
    rows = [(c, name, name.split()[0].lower() + "@post.example", active) for c, (name, active) in CUSTOMERS.items()]
    return spark.createDataFrame(rows, "customer_id long, full_name string, email string, is_active boolean")


def customer_loyalty(spark):
    return spark.createDataFrame(
        [(c, D("0.00"), 0, "Bronze") for c in CUSTOMERS],
        "customer_id long, total_spent decimal(12,2), loyalty_points int, loyalty_tier string",
    )


def suppliers(spark):
    rows = [(1, "Green Hill", True), (9, "Old Quarry", False)]
    return spark.createDataFrame(rows, "supplier_id long, supplier_name string, is_active boolean")


def promotions(spark):
    def around(before, after):
        return NOW - dt.timedelta(days=before), NOW + dt.timedelta(days=after)

    rows = [
        (4, "EARLY15", "Percentage", D("15.00"), D("60.00"), D("90.00"), *around(3, 40), None, 0, True),
        (5, "BIGPOT", "Fixed Amount", D("20.00"), D("150.00"), None, *around(10, 10), 500, 12, True),
        (6, "VANFREE", "Free Shipping", D("0.00"), D("80.00"), None, *around(1, 90), None, 0, True),
        (7, "OVER", "Percentage", D("40.00"), D("0.00"), None, *around(60, -30), None, 3, True),
    ]
    schema = T.StructType(
        [
            T.StructField("promotion_id", T.IntegerType()), T.StructField("promotion_code", T.StringType()),
            T.StructField("promotion_type", T.StringType()), T.StructField("discount_value", T.DecimalType(10, 2)),
            T.StructField("minimum_order_amount", T.DecimalType(10, 2)),
            T.StructField("maximum_discount_amount", T.DecimalType(10, 2)),
            T.StructField("valid_from", T.TimestampNTZType()), T.StructField("valid_to", T.TimestampNTZType()),
            T.StructField("max_uses_total", T.IntegerType()), T.StructField("times_used", T.IntegerType()),
            T.StructField("is_active", T.BooleanType()),
        ]
    )
    return spark.createDataFrame(rows, schema)


REQUEST_SCHEMA = T.StructType(
    [
        T.StructField("request_id", T.LongType()), T.StructField("request_ts", T.TimestampNTZType()),
        T.StructField("customer_id", T.LongType()), T.StructField("items_json", T.StringType()),
        T.StructField("payment_method", T.StringType()), T.StructField("shipping_method", T.StringType()),
        T.StructField("shipping_address", T.StringType()), T.StructField("promotion_code", T.StringType()),
    ]
)


def requests(spark, rows):
    """rows: (request_id, minutes after NOW, customer, items_json, shipping, promo)."""
    return spark.createDataFrame(
        [(rid, NOW + dt.timedelta(minutes=m), c, items, "Credit Card", ship, "{}", promo)
         for rid, m, c, items, ship, promo in rows],
        REQUEST_SCHEMA,
    )

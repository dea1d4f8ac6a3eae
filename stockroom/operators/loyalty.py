"""Loyalty tiers and lifetime value (L1-L3).

The reference walks a cursor over every loyalty row; here the tier rule is
one projection over the table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockroom.functions.money import dec, lit_dec

# Tier thresholds on total spend, highest first.
TIERS = (("Platinum", "5000"), ("Gold", "2000"), ("Silver", "500"))
BASE_TIER = "Bronze"
NEXT_THRESHOLD = {"Bronze": 500, "Silver": 2000, "Gold": 5000}
EXCLUDED = ("Cancelled", "Returned")


def tier_for(spent: Column) -> Column:
    expr = None
    for name, floor in TIERS:
        expr = (F.when if expr is None else expr.when)(spent >= lit_dec(floor), F.lit(name))
    return expr.otherwise(F.lit(BASE_TIER))


def _next_threshold(tier: Column) -> Column:
    expr = None
    for name, value in NEXT_THRESHOLD.items():
        expr = (F.when if expr is None else expr.when)(tier == name, F.lit(value))
    return expr.otherwise(F.lit(None).cast("int"))


def _changed(df: DataFrame) -> Column:
    # '!=' as coded: a NULL current tier is never "changed"
    return tier_for(F.col("total_spent")) != F.col("loyalty_tier")


def loyalty_tiers(customer_loyalty: DataFrame, as_of: dt.date) -> DataFrame:
    """L1: tier by spend (500/2000/5000); effective date and next threshold
    are set where the tier changes."""
    cl = customer_loyalty
    changed = F.coalesce(_changed(cl), F.lit(False))
    new_tier = tier_for(F.col("total_spent"))
    eff = F.col("tier_effective_date") if "tier_effective_date" in cl.columns else F.lit(None).cast("date")
    nxt = F.col("next_tier_threshold") if "next_tier_threshold" in cl.columns else F.lit(None).cast("int")
    # every other column of the snapshot stays as it is
    return cl.withColumns({
        "loyalty_tier": F.when(changed, new_tier).otherwise(F.col("loyalty_tier")),
        "tier_effective_date": F.when(changed, F.lit(as_of)).otherwise(eff),
        "next_tier_threshold": F.when(changed, _next_threshold(new_tier)).otherwise(nxt),
    })


def loyalty_tier_changes(customer_loyalty: DataFrame, as_of: dt.date) -> DataFrame:
    """L2: one 0-point ledger row per changed tier (downgrades included,
    still described as 'Upgraded', as coded)."""
    cl = customer_loyalty.filter(_changed(customer_loyalty))
    new_tier = tier_for(F.col("total_spent"))
    return cl.select(
        "customer_id",
        F.lit(0).alias("points_change"),
        F.lit("Tier Upgrade").alias("transaction_type"),
        F.concat(F.lit("Upgraded from "), F.col("loyalty_tier"), F.lit(" to "), new_tier).alias("description"),
        F.lit(as_of).alias("transaction_date"),
    )


def customer_lifetime_value(
    customer: DataFrame, customer_loyalty: DataFrame, orders: DataFrame
) -> DataFrame:
    """L3: LTV = sum of kept order totals (counted once), last purchase date
    over all orders, and the loyalty total_spent set to the LTV.

    A full recomputation, so later cancellations and returns are reflected.
    """
    per = orders.groupBy("customer_id").agg(
        F.sum(F.when(~F.col("order_status").isin(*EXCLUDED), F.col("total_amount"))).alias("_ltv"),
        F.max("order_date").alias("last_purchase_date"),
    )
    has_loyalty = customer_loyalty.select("customer_id", F.lit(True).alias("_cl"))
    j = customer.select("customer_id").join(per, "customer_id", "left").join(has_loyalty, "customer_id", "left")
    ltv = dec(F.coalesce(F.col("_ltv"), F.lit(0)), 12)
    return j.select(
        "customer_id",
        ltv.alias("total_lifetime_value"),
        "last_purchase_date",
        F.when(F.col("_cl"), ltv).alias("loyalty_total_spent"),
    )

"""Restock and return batches as DAGs with shared stages computed once.

Several outputs of a batch read the same parsed lines and the same checks;
those stages are written once (lineage cut) instead of being recomputed in
every branch. A request table that is itself derived from other tables can
be staged first (``stage_requests``); a stored request table needs no copy.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockroom.functions.money import dec
from stockroom.operators import restock, returns
from stockroom.session import cut_lineage, joined_in_place


class RestockBatch:
    """R1-R6 over one table of restocks."""

    def __init__(self, restocks: DataFrame, product: DataFrame, suppliers: DataFrame, inventory: DataFrame,
                 as_of: dt.datetime, user: str, stage_requests: bool = False):
        self._restocks = restocks
        self.product = product
        self.suppliers = suppliers
        self.inventory = inventory
        self.as_of = as_of
        self.user = user
        self.stage_requests = stage_requests

    @cached_property
    def restocks(self) -> DataFrame:
        return cut_lineage(self._restocks, "restocks") if self.stage_requests else self._restocks

    @cached_property
    def checks(self) -> DataFrame:  # R1
        return cut_lineage(restock.validate_restocks(self.restocks, self.product, self.suppliers, self.inventory), "restock-checks")

    @cached_property
    def valid(self) -> DataFrame:
        return restock.valid_restocks(self.restocks, self.checks)

    @cached_property
    def movements(self) -> DataFrame:  # R4
        return restock.restock_movements(self.valid, self.inventory, self.as_of, self.user)

    def batches(self) -> DataFrame:  # R2
        return restock.restock_batches(self.valid, self.as_of)

    def inventory_after(self) -> DataFrame:  # R3
        return restock.apply_restocks(self.inventory, self.valid, self.as_of.date())

    def resolved(self, low_stock_alerts: DataFrame) -> DataFrame:  # R5
        return restock.resolve_alerts(low_stock_alerts, self.valid, self.as_of)

    def results(self) -> DataFrame:  # R6
        return restock.restock_results(self.restocks, self.checks, self.movements)


class ReturnBatch:
    """T1-T9 over one table of return requests."""

    def __init__(self, requests: DataFrame, order_item: DataFrame, orders: DataFrame, as_of: dt.datetime,
                 stage_requests: bool = False):
        self._requests = requests
        self.order_item = order_item
        self.orders = orders
        self.as_of = as_of
        self.stage_requests = stage_requests

    @cached_property
    def requests(self) -> DataFrame:
        return cut_lineage(self._requests, "return-requests") if self.stage_requests else self._requests

    @cached_property
    def parsed(self) -> DataFrame:
        """T1, planned: requests and items meet by order."""
        return returns.parse_return_requests(self.requests, self.order_item, spread=("order_id",))

    def _stage(self, df: DataFrame, name: str) -> DataFrame:
        with joined_in_place(df.sparkSession):
            return cut_lineage(df, name)

    @cached_property
    def lines(self) -> DataFrame:
        """T1, written: for outputs that have lines."""
        return self._stage(self.parsed, "return-lines")

    @cached_property
    def checked(self) -> DataFrame:
        """T2 per request, with the raw refund of its lines; written once. The
        lines are read where they are written already, else only added up."""
        lines = self.__dict__.get("lines", self.parsed)
        return self._stage(returns.checked_returns(self.requests, returns.line_facts(lines), self.orders), "return-checks")

    @cached_property
    def checks(self) -> DataFrame:  # T2
        return self.checked.drop("_refund_raw")

    @cached_property
    def priced_lines(self) -> DataFrame:  # T3 (lines of accepted requests)
        lines = self.lines  # first, so that the checks read them too
        ok = self.checks.filter(F.col("failed_rule").isNull()).select("request_id")
        return returns.price_returns(lines.join(ok, "request_id", "left_semi"))

    @cached_property
    def refunds(self) -> DataFrame:
        """T3 per accepted request, from the facts of its lines."""
        ok = self.checked.filter(F.col("failed_rule").isNull())
        return ok.groupBy("request_id").agg(dec(F.max("_refund_raw")).alias("refund_amount"))

    @cached_property
    def posted(self) -> DataFrame:  # T4a
        # the raw refund is one per request, whatever the rows of its checks
        ok = self.checked.filter(F.col("failed_rule").isNull()).select("request_id", "customer_id", dec(F.col("_refund_raw")).alias("refund_amount"))
        return returns.post_returns(self.requests.join(ok, "request_id"), None, self.as_of)

    def results(self) -> DataFrame:  # T9
        return returns.return_results(self.requests, self.checks, self.posted)

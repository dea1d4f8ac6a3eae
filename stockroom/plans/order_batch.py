"""The order batch: requests -> O1 -> O2 -> O3/O4 -> O5 -> O6..O13.

``order_batch`` returns lazily built frames for every output table. A job
that writes all of them should persist ``decided`` once (it feeds every
output) and write its batch marker last.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockroom.functions.windows import bucket_mode, hottest_key_rows, rank_within_limit
from stockroom.operators import allocate, orders
from stockroom.session import cut_lineage


class OrderBatch:
    """Lazily built frames of one order batch; O5 runs only when a frame
    that depends on stock decisions is first requested."""

    def __init__(
        self,
        requests: DataFrame,
        customer: DataFrame,
        product: DataFrame,
        inventory: DataFrame,
        promotions: DataFrame,
        stage_requests: bool = False,
    ):
        self._requests = requests
        self.stage_requests = stage_requests
        self.customer = customer
        self.product = product
        self.inventory = inventory
        self.promotions = promotions
        self.round_stats: list = []

    @cached_property
    def requests(self) -> DataFrame:
        """The request table; written once first when it is itself derived
        (e.g. built from other tables), so it is not rebuilt per branch."""
        return cut_lineage(self._requests, "requests") if self.stage_requests else self._requests

    @cached_property
    def lines(self) -> DataFrame:  # O1
        return orders.parse_order_requests(self.requests)

    @cached_property
    def enriched(self) -> DataFrame:
        """Parsed lines with price, active flag and stock; written once, as
        validation, pricing and allocation all read it."""
        return cut_lineage(orders.enrich_lines(self.lines, self.product, self.inventory).drop("product_name"), "order-lines")

    @cached_property
    def validated(self) -> DataFrame:  # O2 on the request rows
        """Request rows with their line facts and first failing rule; the
        line table is reduced once per request for validation and pricing."""
        return orders.validated_requests(self.requests, orders.request_facts(self.enriched), self.customer)

    @cached_property
    def checks(self) -> DataFrame:  # O2
        return self.validated.select("request_id", "failed_rule", "message")

    @cached_property
    def evaluated(self) -> DataFrame:  # O3 + O4 over the validated rows, one pass
        return orders.evaluate_requests(self.validated, self.promotions)

    @cached_property
    def priced(self) -> DataFrame:  # O3, requests that passed O2
        return self.evaluated.filter(F.col("failed_rule").isNull()).select(
            "request_id", "subtotal", "tax_amount", "base_shipping"
        )

    @cached_property
    def promoted(self) -> DataFrame:  # O4
        return self.evaluated.filter(F.col("failed_rule").isNull()).select(
            "request_id", "subtotal", "tax_amount", "base_shipping", *orders.PROMOTED
        )

    @cached_property
    def pre(self) -> DataFrame:
        """Request heads with the first failing rule before stock."""
        pre = self.evaluated.select(
            "request_id", "request_ts", "customer_id", "payment_method", "shipping_method",
            "shipping_address", "promotion_code", "failed_rule", "message",
            "subtotal", "tax_amount", "base_shipping", *orders.PROMOTED,
        )
        negative = F.col("failed_rule").isNull() & (F.col("total_amount") < 0)
        return pre.withColumns(
            {
                "failed_rule": F.when(negative, F.lit(orders.RULE_NEGATIVE)).otherwise(F.col("failed_rule")),
                "message": F.when(negative, F.lit("Order total cannot be negative")).otherwise(F.col("message")),
            }
        )

    @cached_property
    def pre_saved(self) -> DataFrame:
        """``pre`` written once to the checkpoint folder: allocation, the
        stock verdicts and the cap all read it."""
        return cut_lineage(self.pre)

    @cached_property
    def candidates(self) -> DataFrame:
        """Requests that only stock can still reject."""
        return self.pre_saved.filter(F.col("failed_rule").isNull()).select("request_id", "request_ts", "customer_id")

    @cached_property
    def tight_lines(self) -> DataFrame:
        """The lines of products that may run short: an upper bound of the
        demand, taken over all lines whether their request is valid or not,
        exceeds the stock. The other products can reject nothing, so the
        allocation need not see them; where most products are tight, all
        lines are handed over."""
        lines = self.enriched.select("request_id", "product_id", "quantity")
        # repeated request or stock rows repeat a line
        copies = hottest_key_rows(self.candidates, ["request_id"])
        demand = lines.groupBy("product_id").agg(F.sum(F.col("quantity").cast("decimal(30,0)")).alias("_need"))
        stock = self.inventory.groupBy("product_id").agg(F.count(F.lit(1)).alias("_rows"), F.min("quantity_available").alias("_least"))
        short = F.col("_need") * F.col("_rows") * F.lit(copies) > F.col("_least")
        tight = cut_lineage(demand.join(stock, "product_id").filter(F.coalesce(short, F.lit(True))).select("product_id"), "tight-products")
        if 2 * tight.count() > self.inventory.count():
            return lines
        return lines.join(tight, "product_id", "left_semi")

    @cached_property
    def stock_verdicts(self) -> DataFrame:
        """O5 on the requests with a line of a tight product; every other
        candidate is accepted. Written once: the outcomes, the line table and
        the stock messages read it."""
        allocated = allocate.allocate_lines(
            self.tight_lines.join(self.candidates.select("request_id", "request_ts"), "request_id"), self.inventory, stats=self.round_stats)
        return cut_lineage(allocate.allocation_outcomes(allocated), "stock-verdicts")

    @cached_property
    def allocated(self) -> DataFrame:  # O5, line level
        alloc_in = self.enriched.select("request_id", "product_id", "quantity", "price").join(
            self.candidates, "request_id"
        )
        return allocate.allocate_lines(
            alloc_in, self.inventory, carry=("price", "customer_id"),
            decided=self.stock_verdicts.select("request_id", "accepted"),
        )

    @cached_property
    def outcomes(self) -> DataFrame:  # O5, per request
        every = self.candidates.select("request_id").distinct()
        return every.join(self.stock_verdicts, "request_id", "left").withColumn("accepted", F.coalesce("accepted", F.lit(True)))

    @cached_property
    def with_stock(self) -> DataFrame:
        """Requests with the stock verdict; written once, as the accepted and
        the rejected branch and the promotion cap all read it."""
        stock_msg = F.concat(
            F.lit("Insufficient stock for Product ID "), F.col("short_product_id").cast("string"),
            F.lit(". Requested: "), F.col("requested").cast("string"),
            F.lit(", Available: "), F.col("available").cast("string"),
        )
        # a candidate without a verdict has no line that can run short
        w = self.pre_saved.join(self.stock_verdicts, "request_id", "left")
        rejected = F.col("failed_rule").isNull() & (F.col("accepted") == F.lit(False))
        stocked = w.withColumns(
            {
                "failed_rule": F.when(rejected, F.lit(orders.RULE_STOCK)).otherwise(F.col("failed_rule")),
                "message": F.when(rejected, stock_msg).otherwise(F.col("message")),
            }
        ).drop("accepted", "short_product_id", "requested", "available")
        return cut_lineage(stocked, "order-stocked")

    @cached_property
    def accepted(self) -> DataFrame:
        """Accepted requests with final amounts (O9 cap applied).

        Among accepted orders holding a capped promotion only the first
        (max_uses_total - times_used) in arrival order keep it; the rest
        are repriced without it. A promotion with more than a bounded number
        of holders is counted two-level (promotion, range bucket).
        """
        ok = self.with_stock.filter(F.col("failed_rule").isNull())
        # accepted holders of a promotion are a subset of its candidates in
        # the written pre-stock table: count there, not over the stock plan
        candidates = self.pre_saved.filter(F.col("failed_rule").isNull() & F.col("max_uses_total").isNotNull())
        mode = bucket_mode(candidates, ["promotion_id"])
        capped = rank_within_limit(
            ok.filter(F.col("max_uses_total").isNotNull()).select(
                "request_id", "request_ts", "promotion_id", "max_uses_total", "times_used"
            ),
            keys=["promotion_id"],
            order=["request_ts", "request_id"],
            limit=F.col("max_uses_total") - F.col("times_used"),
            bucket=mode,
            out="_granted",
        ).select("request_id", "_granted")
        ok = ok.join(capped, "request_id", "left")
        lost = F.col("_granted") == F.lit(False)
        kept = ok.filter(~lost | F.col("_granted").isNull())
        return orders.without_promotion(ok.filter(lost)).unionByName(kept).drop("_granted")

    @cached_property
    def decided(self) -> DataFrame:
        return self.accepted.unionByName(self.rejected)

    @cached_property
    def rejected(self) -> DataFrame:
        return self.with_stock.filter(F.col("failed_rule").isNotNull())

    @cached_property
    def accepted_lines(self) -> DataFrame:
        return orders.line_ids(
            self.allocated.filter(F.col("accepted")).select(
                "request_id", "request_ts", "customer_id", "product_id", "quantity", "price",
                "available_before",
            )
        )


def order_batch(
    requests: DataFrame,
    customer: DataFrame,
    product: DataFrame,
    inventory: DataFrame,
    promotions: DataFrame,
    stage_requests: bool = False,
) -> OrderBatch:
    return OrderBatch(requests, customer, product, inventory, promotions, stage_requests)

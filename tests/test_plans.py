"""Plan-level properties: checked broadcasts, one pass over order lines,
ledger files clustered by reference."""

import glob
import tempfile

import pyarrow.parquet as pq
from pyspark.sql import functions as F

import seeds
from conftest import SF0001
from stockroom.functions.joins import broadcast_if_small
from stockroom.operators import orders
from stockroom.plans import jobs
from stockroom.plans.order_batch import order_batch
from stockroom.sources.fixtures import Fixtures


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _static_plans(spark):
    """Plan as on large data: no size-based broadcast, no runtime re-plan."""
    saved = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    return saved


def _restore(spark, saved):
    for k, v in saved.items():
        spark.conf.set(k, v)


def test_broadcast_only_below_the_checked_bound(spark):
    saved = _static_plans(spark)
    try:
        big = spark.range(1000).withColumn("k", F.col("id") % 7)
        dim = spark.createDataFrame([(i, f"v{i}") for i in range(5)], "k long, v string")
        small_plan = _plan(big.join(broadcast_if_small(dim), "k"))
        assert "BroadcastHashJoin" in small_plan
        over_plan = _plan(big.join(broadcast_if_small(dim, max_rows=4), "k"))
        assert "BroadcastHashJoin" not in over_plan and "SortMergeJoin" in over_plan
    finally:
        _restore(spark, saved)


def test_order_batch_shuffles_lines_once_and_broadcasts_promotions(spark):
    f = Fixtures(spark, SF0001)
    b = order_batch(f.order_requests, f.customer, f.product, f.inventory_ample, f.promotions, stage_requests=True)
    b.requests, b.enriched  # staged tables
    saved = _static_plans(spark)
    try:
        plan = _plan(b.pre)
    finally:
        _restore(spark, saved)
    # the written line table (the only scan with ``_known``) is read once,
    # for one aggregate exchange by request_id
    line_scans = [ln for ln in plan.splitlines() if "FileScan" in ln and "_known#" in ln]
    assert len(line_scans) == 1
    assert plan.count("Exchange hashpartitioning(request_id") == 2  # lines + requests
    # promotion codes have few values: never a shuffle keyed by the code
    assert "hashpartitioning(_code" not in plan
    assert plan.count("BroadcastHashJoin") >= 1


def test_fused_pricing_equals_standalone_operators(spark):
    f = Fixtures(spark, SF0001)
    b = order_batch(f.order_requests, f.customer, f.product, f.inventory_ample, f.promotions, stage_requests=True)
    passed = b.checks.filter(F.col("failed_rule").isNull()).select("request_id")
    priced = orders.price_orders(b.enriched.join(passed, "request_id", "left_semi"), b.requests)
    promoted = orders.apply_promotions(priced, b.requests, f.promotions)
    assert b.priced.count() == priced.count() > 0
    assert b.priced.exceptAll(priced).count() == 0 and priced.exceptAll(b.priced).count() == 0
    cols = promoted.columns
    assert b.promoted.select(cols).exceptAll(promoted).count() == 0
    assert promoted.exceptAll(b.promoted.select(cols)).count() == 0
    lines = orders.enrich_lines(orders.parse_order_requests(f.order_requests), f.product, f.inventory_ample)
    standalone = orders.validate_order_requests(f.order_requests, lines, f.customer)
    assert b.checks.exceptAll(standalone).count() == 0 and standalone.exceptAll(b.checks).count() == 0


def test_ledger_files_sorted_by_reference(spark):
    root = tempfile.mkdtemp(prefix="stockroom-ledger-", dir="/tmp")
    items = '[{"product_id": 1, "quantity": 2}, {"product_id": 5, "quantity": 3}]'
    reqs = seeds.requests(spark, [(rid, 0, 1, items, "STANDARD", None) for rid in (9, 3, 7, 1, 5)])
    b = order_batch(reqs, seeds.customer(spark), seeds.product(spark), seeds.inventory(spark), seeds.promotions(spark))
    jobs.write_order_batch(b, seeds.promotions(spark), seeds.customer_loyalty(spark), root, "b0001")
    files = glob.glob(f"{root}/inventory_log/batch_id=b0001/*.parquet")
    assert files
    total = 0
    for path in files:
        refs = pq.read_table(path, columns=["reference_id"]).column("reference_id").to_pylist()
        assert refs == sorted(refs)
        total += len(refs)
    assert total == spark.read.parquet(f"{root}/inventory_log").count() > 0


def test_order_lines_parse_once_and_aggregate_before_the_shuffle(spark):
    """A request's JSON is parsed once, whatever its number of items, and
    duplicate lines are summed in the map tasks before the one exchange."""
    root = tempfile.mkdtemp(prefix="stockroom-reqs-", dir="/tmp")
    items = '[{"product_id": 1, "quantity": 1}, {"product_id": 1, "quantity": "2"}, {"product_id": 5, "quantity": 0}]'
    seeds.requests(spark, [(1, 0, 1, items, "STANDARD", None)]).write.parquet(root + "/r")
    lines = orders.parse_order_requests(spark.read.parquet(root + "/r"))
    plan = _plan(lines)
    physical = plan[plan.index("== Physical Plan =="):] if "== Physical Plan ==" in plan else plan
    assert physical.count("from_json(") == 1
    assert physical.index("Exchange hashpartitioning") < physical.index("partial_try_sum")
    assert [(r["product_id"], r["quantity"]) for r in lines.collect()] == [(1, 3)]


def test_return_steps_shuffle_their_lines_once(spark):
    """Requests come from the one pass that numbers the order items, and their
    lines are spread once for both the merge and the join with the items."""
    from stockroom.operators import returns
    from stockroom.sources.fixtures import Fixtures

    saved = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        f = Fixtures(spark, SF0001)
        schema = "request_id long, order_id long, items_json string"
        lines = returns.parse_return_requests(spark.createDataFrame([(1, 2, "[]")], schema), f.order_item)
        shuffles = [d._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") for d in (f.return_requests, lines)]
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
    assert shuffles == [1, 3]  # lines: one of their own, two of the order items


def test_return_checks_move_lines_by_order_once(spark, monkeypatch):
    """Checks of returns shuffle requests' lines and order items once each, by
    order, and outputs without lines write none; a request that two orders
    share, a null order and two requests for an order keep their results."""
    from stockroom.plans import side_batches
    from stockroom.session import joined_in_place

    written = []
    real = side_batches.cut_lineage

    def noted(df, name):
        written.append((name, _plan(df).count("Exchange hashpartitioning")))
        return real(df, name)

    monkeypatch.setattr(side_batches, "cut_lineage", noted)
    one = lambda *items: "[" + ", ".join(f'{{"order_item_id": {i}, "quantity": {n}, "condition": "New"}}' for i, n in items) + "]"
    root = tempfile.mkdtemp(prefix="stockroom-returns-", dir="/tmp")
    requests = [(1, 10, one((101, 1), (102, 2))), (2, 10, one((101, 1))), (3, 11, one((111, 9))), (4, 11, one((111, 1), (111, 1))), (4, 12, one((121, 1))),
                (5, None, one((101, 1))), (6, 13, one((101, 1)))]
    spark.createDataFrame([(*r, "why", "card") for r in requests], "request_id long, order_id long, items_json string, return_reason string, refund_method string").write.parquet(root + "/r")
    spark.createDataFrame([(101, 10, 1, 1, 2.0), (102, 10, 2, 3, 3.0), (111, 11, 1, 3, 5.0), (121, 12, 1, 1, 7.0)],
                          "order_item_id long, order_id long, product_id long, quantity int, price double").write.parquet(root + "/i")
    spark.createDataFrame([(10, 1, "Shipped"), (11, 2, "Shipped"), (12, 3, "Shipped"), (13, 4, "Cancelled")], "order_id long, customer_id long, order_status string").write.parquet(root + "/o")
    item = spark.read.parquet(root + "/i").withColumn("unit_price", F.col("price").cast("decimal(10,2)")).repartition("order_id")
    saved = _static_plans(spark)
    try:
        with joined_in_place(spark):
            batch = side_batches.ReturnBatch(spark.read.parquet(root + "/r"), item, spark.read.parquet(root + "/o"), seeds.NOW)
            found = sorted((r["request_id"], r["status"], r["return_number"] and r["message"]) for r in batch.results().collect())
        assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"
    finally:
        _restore(spark, saved)
    # lines, items, facts; requests by request and by order, orders
    assert written == [("return-checks", 6)]
    number = lambda k: f"Return RET-{seeds.NOW:%Y%m%d}-{k} processed successfully. Refund amount: $"
    # both rows of request 4 are accepted with its whole refund, and each step by request joins both with both
    assert found == [(1, "SUCCESS", number(1) + "8.00"), (2, "ERROR", None), (3, "ERROR", None),
                     *16 * [(4, "SUCCESS", number(4) + "17.00")], (5, "ERROR", None), (6, "ERROR", None)]

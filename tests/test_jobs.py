"""Batch jobs write every effect, are idempotent per batch and mark batches last."""

import os
import tempfile

from pyspark.sql import functions as F

import seeds
from stockroom.plans import jobs
from stockroom.plans.order_batch import order_batch

ITEMS = '[{"product_id": 1, "quantity": 2}, {"product_id": 5, "quantity": 3}]'


def test_order_batch_job_idempotent(spark):
    root = tempfile.mkdtemp(prefix="stockroom-jobs-", dir="/tmp")
    reqs = seeds.requests(spark, [
        (1, 0, 1, ITEMS, "STANDARD", "EARLY15"),
        (2, 1, 1, '[{"product_id": 1, "quantity": 1000}]', "STANDARD", None),
    ])

    def run():
        b = order_batch(reqs, seeds.customer(spark), seeds.product(spark), seeds.inventory(spark),
                        seeds.promotions(spark))
        return jobs.write_order_batch(b, seeds.promotions(spark), seeds.customer_loyalty(spark), root, "b0001")

    assert run() == {"accepted": 1, "rejected": 1}
    run()  # rerun replaces its own partition
    assert spark.read.parquet(f"{root}/orders").count() == 1
    assert spark.read.parquet(f"{root}/order_item").count() == 2
    assert spark.read.parquet(f"{root}/system_error_log").count() == 1
    inv = jobs.latest_snapshot(spark, root, "inventory")
    assert inv.filter("product_id = 1").first()["quantity_reserved"] == 2
    promos = jobs.latest_snapshot(spark, root, "promotions")
    assert promos.filter(F.col("promotion_code") == "EARLY15").first()["times_used"] == 1
    assert jobs.completed_batches(spark, root).count() == 1


def test_restock_and_return_jobs(spark):
    import datetime as dt
    from decimal import Decimal as D

    from stockroom.plans.side_batches import RestockBatch, ReturnBatch

    root = tempfile.mkdtemp(prefix="stockroom-jobs-", dir="/tmp")
    rs = spark.createDataFrame(
        [(1, 1, 100, "LOT-7", 1, D("10.00")), (2, 2, -5, None, None, D("3.00"))],
        "restock_id long, product_id long, quantity int, batch_number string, supplier_id long, unit_cost decimal(10,2)",
    )
    alerts = spark.createDataFrame([(1, "INFO", 9, 10, False)],
                                   "product_id long, alert_level string, current_quantity int, reorder_point int, resolved boolean")
    rb = RestockBatch(rs, seeds.product(spark), seeds.suppliers(spark), seeds.inventory(spark), seeds.NOW, "tester")
    assert jobs.write_restock_batch(rb, alerts, root, "r0001") == {"valid": 1}
    assert jobs.latest_snapshot(spark, root, "inventory").filter("product_id = 1").first()["quantity_on_hand"] == 144
    resolved = jobs.latest_snapshot(spark, root, "low_stock_alerts").filter("product_id = 1").first()
    assert resolved["resolved"] and resolved["resolution_notes"] == "Resolved by restock of 100 units"

    orders_df = spark.createDataFrame(
        [(10, 1, dt.datetime(2025, 1, 1), D("100.00"), "Delivered")],
        "order_id long, customer_id long, order_date timestamp_ntz, total_amount decimal(10,2), order_status string",
    )
    items = spark.createDataFrame([(1001, 10, 5, 2, D("35.00"))],
                                  "order_item_id long, order_id long, product_id long, quantity int, unit_price decimal(10,2)")
    req = spark.createDataFrame(
        [(10, 10, '[{"order_item_id": 1001, "quantity": 2, "condition": "New"}]', "size", "card")],
        "request_id long, order_id long, items_json string, return_reason string, refund_method string",
    )
    tb = ReturnBatch(req, items, orders_df, seeds.NOW)
    assert jobs.write_return_batch(tb, seeds.inventory(spark), seeds.customer_loyalty(spark), root, "t0001", "tester") == {"accepted": 1}
    assert jobs.latest_snapshot(spark, root, "orders").first()["order_status"] == "Returned"
    ret = spark.read.parquet(f"{root}/returns").first()
    assert ret["refund_amount"] == D("70.00") and ret["return_number"].startswith("RET-20250115-")
    assert spark.read.parquet(f"{root}/loyalty_transactions").first()["points_change"] == -7


def test_job_drops_its_lineage_tables(spark):
    from stockroom.session import ensure_checkpoint_dir

    lineage = ensure_checkpoint_dir(spark).replace("file:", "") + "/lineage"

    def listing():
        return set(os.listdir(lineage)) if os.path.isdir(lineage) else set()

    root = tempfile.mkdtemp(prefix="stockroom-jobs-", dir="/tmp")
    reqs = seeds.requests(spark, [(1, 0, 1, ITEMS, "STANDARD", None)])
    b = order_batch(reqs, seeds.customer(spark), seeds.product(spark), seeds.inventory(spark),
                    seeds.promotions(spark), stage_requests=True)
    before = listing()
    assert jobs.write_order_batch(b, seeds.promotions(spark), seeds.customer_loyalty(spark), root, "b0001") == {
        "accepted": 1}
    assert listing() <= before  # staged requests, lines, rounds and verdicts are gone
    assert spark.read.parquet(f"{root}/order_item").count() == 2  # outputs stay


def test_lineage_scope_records_and_drops(spark):
    from stockroom.session import cut_lineage, lineage_scope

    with lineage_scope(spark) as paths:
        staged = cut_lineage(spark.range(5), "scope-test")
        assert staged.count() == 5
        local = paths[0].replace("file:", "")
        assert os.path.isdir(local)
    assert len(paths) == 1 and not os.path.exists(local)
    # a failing block keeps its tables
    try:
        with lineage_scope(spark) as kept:
            cut_lineage(spark.range(3), "scope-fail")
            raise RuntimeError("job failed")
    except RuntimeError:
        pass
    assert os.path.isdir(kept[0].replace("file:", ""))


def test_ledger_lookup_reads_the_files_of_its_reference(spark):
    """The stored ledger answers by pushed filters; batches of different kinds lie side by side."""
    root = tempfile.mkdtemp(prefix="stockroom-ledger-", dir="/tmp")
    moves = spark.range(2000).selectExpr("id as log_id", "id % 50 as product_id", "1 as quantity_change", "'ORDER' as transaction_type",
                                         "id % 400 as reference_id", "'orders' as reference_table", "cast(id as int) as new_quantity")
    jobs.write_ledger(moves, root, "b1")
    jobs.write_ledger(moves.selectExpr("log_id + 10000 as log_id", "product_id", "reference_id", "'inventory_batch' as reference_table",
                                       "reference_id as batch_id", "'x' as notes"), root, "r1")
    found = jobs.ledger_by_reference(spark, root, 77, "orders", n=3)
    assert [r["log_id"] for r in found.collect()] == [1677, 1277, 877]
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = found._jdf.queryExecution().explainString(mode)
    pushed = next(line for line in plan.splitlines() if line.startswith("PushedFilters"))
    assert "EqualTo(reference_id,77)" in pushed and "EqualTo(reference_table,orders)" in pushed
    assert not any(x in plan for x in ("Window", "Join", "Python", "Exchange hashpartitioning"))
    lots = jobs.ledger_by_reference(spark, root, 77, "inventory_batch").collect()
    assert len(lots) == 5 and {r["batch_id"] for r in lots} == {77}


def test_retention_drops_days_and_rewrites_the_border(spark):
    import datetime as dt
    import glob

    path = tempfile.mkdtemp(prefix="stockroom-log-", dir="/tmp") + "/log"
    log = spark.range(240).selectExpr("id", "if(id % 60 = 59, null, timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, cast(id as int))) as at")
    jobs.write_log_by_day(log, "at", path)
    limit = dt.datetime(2024, 1, 4, 9, 30)

    def files():
        return {f: os.stat(f).st_mtime_ns for f in glob.glob(path + "/log_day=*/*.parquet")}

    def kept():
        return sorted((r["id"] for r in jobs.read_log_by_day(spark, path, log.schema).collect()))

    expect = sorted(r["id"] for r in log.filter(F.col("at").isNull() | (F.col("at") >= F.lit(limit))).collect())
    before = files()
    assert jobs.drop_old_days(spark, path, "at", log.schema, limit) == 3 and kept() == expect
    after = files()
    touched = {f for f in after if before.get(f) != after[f]}
    assert touched and all("log_day=2024-01-04" in f for f in touched)
    assert jobs.drop_old_days(spark, path, "at", log.schema, limit) == 0
    assert files() == after  # a second run changes nothing
    # a crash between the staged border day and its folder: the stage is put in place
    border = path + "/log_day=2024-01-04"
    spark.read.schema(log.schema).parquet(border).write.parquet(path + "/_border")
    for f in glob.glob(border + "/*.parquet")[:1]:
        os.remove(f)
    jobs.drop_old_days(spark, path, "at", log.schema, limit)
    assert kept() == expect and not os.path.exists(path + "/_border")

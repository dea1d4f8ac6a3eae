"""Batch jobs: run a batch and write all its effects, marker last.

Parquet has no transactions across tables, so a batch is made safe by
construction:

* append-only tables (orders, order items, ledgers, usage, shipping, logs)
  are written partitioned by ``batch_id``; a rerun of a batch first removes
  its own partition, also when it now yields no rows;
* updated tables (inventory, promotions, loyalty balances, orders after
  returns) are written as a *new snapshot* folder per batch, never over the
  folder being read;
* every effect is derived from one written (lineage-cut) decision table, and
  the batch marker row is written last. Readers take the latest snapshot
  of a batch that has a marker;
* the job's intermediate (lineage) tables are dropped after the marker, so
  storage grows with the outputs only.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockroom.operators import health, orders, returns, rules
from stockroom.plans.order_batch import OrderBatch
from stockroom.plans.side_batches import RestockBatch, ReturnBatch
from stockroom.session import cut_lineage, drop_tables, lineage_scope, list_folder, path_exists

MARKERS = "_batches"


# Ledgers are read back by reference (H17): every file holds a range of
# references, sorted, so that files and row groups have tight min/max values
# and a lookup skips all others.
LEDGER_SORT = ("reference_id", "log_id")


def _append(df: DataFrame, root: str, table: str, batch_id: str, sort_by: tuple[str, ...] = ()) -> int:
    if sort_by:
        df = df.repartitionByRange(*sort_by).sortWithinPartitions(*sort_by)
    df.write.mode("overwrite").parquet(f"{root}/{table}/batch_id={batch_id}")
    return 0


def _snapshot(df: DataFrame, root: str, table: str, batch_id: str) -> str:
    path = f"{root}/snapshots/{table}/batch_id={batch_id}"
    df.write.mode("overwrite").parquet(path)
    return path


def _mark(spark: SparkSession, root: str, batch_id: str, kind: str, counts: dict) -> None:
    row = [(batch_id, kind, dt.datetime.now(dt.timezone.utc).replace(tzinfo=None), str(counts))]
    # ``batch`` keeps the id as text: a partition column of digits is read as a number
    spark.createDataFrame(row, "batch string, kind string, written_at timestamp_ntz, counts string").write.mode(
        "overwrite"
    ).parquet(f"{root}/{MARKERS}/batch_id={batch_id}")


def completed_batches(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{MARKERS}")


def latest_snapshot(spark: SparkSession, root: str, table: str) -> DataFrame | None:
    """The snapshot of ``table`` whose batch marker was written last (batch
    ids are names: their order says nothing); None before the first one."""
    if not path_exists(spark, f"{root}/{MARKERS}") or not path_exists(spark, f"{root}/snapshots/{table}"):
        return None
    done = completed_batches(spark, root).select("batch", "written_at")
    for row in done.orderBy(F.desc("written_at"), F.desc("batch")).toLocalIterator():
        path = f"{root}/snapshots/{table}/batch_id={row['batch']}"
        if path_exists(spark, path):
            return spark.read.parquet(path)
    return None


def _write_order_batch(
    batch: OrderBatch, promotions: DataFrame, customer_loyalty: DataFrame, root: str, batch_id: str
) -> dict:
    """Write every effect of an order batch."""
    spark = batch.requests.sparkSession
    decided = cut_lineage(batch.decided, "order-decided")
    accepted = decided.filter(F.col("failed_rule").isNull())
    lines = cut_lineage(batch.accepted_lines, "order-accepted-lines")
    usage = orders.promotion_usage(accepted)
    accrual = orders.loyalty_accrual(accepted)
    _append(orders.post_orders(accepted), root, "orders", batch_id)
    _append(orders.post_order_items(lines), root, "order_item", batch_id)
    _append(orders.order_movements(lines), root, "inventory_log", batch_id, LEDGER_SORT)
    _append(usage, root, "promotion_usage", batch_id)
    _append(orders.shipping_plan(accepted), root, "shipping_info", batch_id)
    _append(accrual, root, "loyalty_transactions", batch_id)
    _append(orders.order_results(decided), root, "order_results", batch_id)
    _append(orders.rejected_requests(decided), root, "system_error_log", batch_id)
    _snapshot(orders.reserve_inventory(batch.inventory, lines), root, "inventory", batch_id)
    _snapshot(orders.promotion_times_used(promotions, usage), root, "promotions", batch_id)
    _snapshot(orders.loyalty_balances(customer_loyalty, accrual, accepted), root, "customer_loyalty", batch_id)
    counts = decided.groupBy(F.col("failed_rule").isNull().alias("ok")).count().collect()
    summary = {("accepted" if r["ok"] else "rejected"): r["count"] for r in counts}
    _mark(spark, root, batch_id, "orders", summary)
    return summary


def _write_restock_batch(batch: RestockBatch, low_stock_alerts: DataFrame, root: str, batch_id: str) -> dict:
    """Write every effect of a restock batch (R1-R6), the alerts raised by
    the new levels (A1) and then resolved by the restock (R5), marker last."""
    spark = batch.restocks.sparkSession
    after = cut_lineage(batch.inventory_after(), "restock-inventory")
    raised = rules.low_stock_alerts(batch.inventory, after, batch.product, batch.as_of).drop("alert_date")
    raised = raised.withColumn("alert_date", F.lit(batch.as_of.strftime("%Y-%m-%d")).cast("date"))
    alerts = low_stock_alerts.unionByName(raised, allowMissingColumns=True)
    _append(batch.batches(), root, "inventory_batch", batch_id)
    _append(batch.movements, root, "inventory_log", batch_id, LEDGER_SORT)
    _append(batch.results(), root, "restock_results", batch_id)
    _snapshot(after, root, "inventory", batch_id)
    _snapshot(batch.resolved(alerts), root, "low_stock_alerts", batch_id)
    summary = {"valid": batch.valid.count()}
    _mark(spark, root, batch_id, "restocks", summary)
    return summary


def _write_return_batch(
    batch: ReturnBatch, inventory: DataFrame, customer_loyalty: DataFrame, root: str, batch_id: str, user: str
) -> dict:
    """Write every effect of a return batch (T1-T9), marker last."""
    spark = batch.requests.sparkSession
    priced = cut_lineage(batch.priced_lines, "return-accepted-lines")
    posted = cut_lineage(batch.posted, "returns-posted")
    clawback = returns.loyalty_clawback(posted, batch.as_of)
    _append(posted, root, "returns", batch_id)
    _append(returns.post_return_items(priced), root, "return_items", batch_id)
    _append(returns.return_restock_movements(priced, inventory, batch.as_of, user), root, "inventory_log", batch_id, LEDGER_SORT)
    _append(clawback, root, "loyalty_transactions", batch_id)
    _append(returns.return_results(batch.requests, batch.checks, posted), root, "return_results", batch_id)
    _snapshot(returns.return_inventory(inventory, priced), root, "inventory", batch_id)
    _snapshot(returns.mark_orders_returned(batch.orders, posted), root, "orders", batch_id)
    _snapshot(returns.clawback_balances(customer_loyalty, clawback), root, "customer_loyalty", batch_id)
    summary = {"accepted": posted.count()}
    _mark(spark, root, batch_id, "returns", summary)
    return summary


LEDGER = (
    "log_id long, product_id long, quantity_change int, transaction_type string, transaction_subtype string, reference_id long, "
    "reference_table string, batch_id long, previous_quantity int, new_quantity int, performed_by string, notes string, log_date timestamp_ntz"
)


def write_ledger(movements: DataFrame, root: str, batch_id: str) -> None:
    """Append a batch's movements to the ledger, for lookups by reference."""
    _append(movements, root, "inventory_log", batch_id, LEDGER_SORT)


def ledger_by_reference(
    spark: SparkSession, root: str, reference_id: int, reference_table: str | None = None, n: int = 5
) -> DataFrame:
    """H17 on the written ledger: the filter on the reference is pushed to the
    files, which are sorted by it; nothing of the batch is computed again."""
    # the folders of the batches one by one: the rows' own batch_id is a lot's, not the folder's
    ledger = spark.read.schema(LEDGER).parquet(f"{root}/inventory_log/*")
    return health.movements_by_reference(ledger, reference_id, reference_table, n)


def retention_job(log: DataFrame, ts_col: str, as_of: dt.date, days: int, root: str, table: str,
                  batch_id: str) -> str:
    """H15 as a job on a log that is not stored by day: the kept rows become
    the next snapshot of the log (see ``drop_old_days``)."""
    return _snapshot(health.log_retention(log, ts_col, as_of, days), root, table, batch_id)


DAY_COLUMN = "log_day"


def write_log_by_day(log: DataFrame, ts_col: str, path: str) -> None:
    """Append log rows to folders by day. Rows without a time have a folder of
    their own (the store's default partition)."""
    log.withColumn(DAY_COLUMN, F.to_date(ts_col)).write.mode("append").partitionBy(DAY_COLUMN).parquet(path)


def read_log_by_day(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    whole = T.StructType([*schema.fields, T.StructField(DAY_COLUMN, T.DateType())])
    return spark.read.schema(whole).parquet(path).select(*schema.fieldNames())


def _days(spark: SparkSession, path: str) -> list[dt.date]:
    names = [n.removeprefix(DAY_COLUMN + "=") for n in list_folder(spark, path) if n.startswith(DAY_COLUMN + "=")]
    return sorted(dt.date.fromisoformat(n) for n in names if n != "__HIVE_DEFAULT_PARTITION__")


def drop_old_days(spark: SparkSession, path: str, ts_col: str, schema: T.StructType, before: dt.datetime) -> int:
    """H15 as a delete by partition: the folders of days that end before the
    limit go, the limit's own day is written anew without its older rows, and
    no file of a kept day is touched. Returns the number of folders dropped.

    Safe to run again at any point: the border day is staged beside the log
    first, and a complete stage that a crash has left behind is put in place
    before anything else. A second run changes nothing.
    """
    border, stage = f"{path}/{DAY_COLUMN}={before.date()}", f"{path}/_border"
    if path_exists(spark, stage) and not path_exists(spark, stage + "/_SUCCESS"):
        drop_tables(spark, [stage])  # a stage that was never complete
    if not path_exists(spark, stage) and path_exists(spark, border):
        day = spark.read.schema(schema).parquet(border)
        old = F.col(ts_col) < F.lit(before)
        if not day.filter(old).isEmpty():
            day.filter(~old).write.parquet(stage)
    if path_exists(spark, stage):
        spark.read.schema(schema).parquet(stage).write.mode("overwrite").parquet(border)
        drop_tables(spark, [stage])
    gone = [f"{path}/{DAY_COLUMN}={d}" for d in _days(spark, path) if d < before.date()]
    drop_tables(spark, gone)
    return len(gone)


# Each job runs in one lineage scope: its intermediate tables are dropped
# once the marker is written. The session comes from the raw input, so
# staging it happens inside the scope.
def write_order_batch(
    batch: OrderBatch, promotions: DataFrame, customer_loyalty: DataFrame, root: str, batch_id: str
) -> dict:
    """Write every effect of an order batch (O6-O13, O7, O9, O11), marker last."""
    with lineage_scope(batch._requests.sparkSession):
        return _write_order_batch(batch, promotions, customer_loyalty, root, batch_id)


def write_restock_batch(batch: RestockBatch, low_stock_alerts: DataFrame, root: str, batch_id: str) -> dict:
    """Write every effect of a restock batch (R1-R6, A1), marker last."""
    with lineage_scope(batch._restocks.sparkSession):
        return _write_restock_batch(batch, low_stock_alerts, root, batch_id)


def write_return_batch(
    batch: ReturnBatch, inventory: DataFrame, customer_loyalty: DataFrame, root: str, batch_id: str, user: str
) -> dict:
    """Write every effect of a return batch (T1-T9), marker last."""
    with lineage_scope(batch._requests.sparkSession):
        return _write_return_batch(batch, inventory, customer_loyalty, root, batch_id, user)

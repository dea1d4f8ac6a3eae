"""Streaming forms of the change-driven rules.

Each job reads a file-source stream (``maxFilesPerTrigger`` micro-batches),
applies a watermarked stateful operator and writes an exactly-once sink
(file sink or a foreachBatch changelog) whose result is read back as a batch
DataFrame. Watermarks need TIMESTAMP (not TIMESTAMP_NTZ) event times, so the
event column is cast on the way in and back on the way out (session time
zone UTC keeps the wall-clock value).
"""

from __future__ import annotations

import datetime as dt
import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockroom.session import scratch_path
from stockroom.streaming.batch_log import BatchLog
from stockroom.streaming.feeds import END_OF_INPUT
from stockroom.streaming.ordered_state import keyed_state, late_rows, on_time, ordered_fold

# Files of the feed that a micro-batch reads; the registered queries pass 1 to
# deliver their slices one by one.
FILES_PER_TRIGGER = 1000
TRACKED = ("full_name", "email", "phone", "shipping_address")


def _run_to_end(query) -> None:
    """Drive the query over everything available, then stop it."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def _end():
    return F.lit(END_OF_INPUT.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp")


def _folder(spark: SparkSession, job: str) -> str:
    return scratch_path(spark, f"streams/{job}-{uuid.uuid4().hex}")


def _fold_to_end(out: DataFrame, folder: str, columns: list[str], time_col: str, late_path: str | None) -> DataFrame:
    """Run an ``ordered_fold`` to the end of its feed; the late rows go to
    ``late_path`` as they came in, the fold's output is returned."""
    spark = out.sparkSession
    with keyed_state(spark):
        _run_to_end(
            out.writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", folder + "/_checkpoint").start(folder + "/out")
        )
    sink = spark.read.schema(out.schema).parquet(folder + "/out")
    late_rows(sink, time_col).write.mode("overwrite").parquet(late_path or folder + "/late")
    return on_time(sink, columns)


# ------------------------------------------------------------------ X1 ----
ALERT_SCHEMA = T.StructType(
    [
        T.StructField("alert_id", T.LongType()),
        T.StructField("product_id", T.IntegerType()),
        T.StructField("alert_level", T.StringType()),
        T.StructField("current_quantity", T.IntegerType()),
        T.StructField("reorder_point", T.IntegerType()),
        T.StructField("message", T.StringType()),
        T.StructField("alert_us", T.LongType()),
    ]
)
ALERT_CARRY = T.StructType([T.StructField("level", T.LongType())])


def _alert_fold(key, carry, rows: pd.DataFrame):
    """Apply movements in order: level += change; alert when the level
    changed and is at or below the reorder point (bands are exact integer
    tests: 5*q <= rp is q <= 0.2 rp, 20*q <= 9*rp is q <= 0.45 rp)."""
    start = int(carry["level"]) if carry else int(rows["quantity_on_hand"].iloc[0])
    levels = start + rows["quantity_change"].astype("int64").cumsum()
    rp = rows["reorder_point"].astype("int64")
    hit = (rows["quantity_change"] != 0) & (levels <= rp)
    band = pd.Series("INFO", index=rows.index)
    band[20 * levels <= 9 * rp] = "WARNING"
    band[5 * levels <= rp] = "CRITICAL"
    out = pd.DataFrame(
        {
            "alert_id": rows["event_id"].astype("int64"),
            "product_id": int(key[0]),
            "alert_level": band,
            "current_quantity": levels.astype("int32"),
            "reorder_point": rp.astype("int32"),
            "message": rows["product_name"].astype(str) + " stock is at " + levels.astype(str)
            + " units (reorder point: " + rp.astype(str) + "). Level: " + band,
            "alert_us": rows["event_us"],
        }
    )[hit.values]
    return {"level": int(levels.iloc[-1])}, out


def low_stock_alert_stream(
    spark: SparkSession,
    feed_path: str,
    movement_schema: T.StructType,
    inventory: DataFrame,
    product: DataFrame,
    watermark: str,
    files_per_trigger: int = FILES_PER_TRIGGER,
) -> DataFrame:
    """Movements stream -> banded low-stock alerts in event-time order.

    The static stock and product tables are joined to the stream (stream-
    static join, broadcast when small); the per-product fold keeps rows
    until the watermark passes them.
    """
    stream = (
        spark.readStream.schema(movement_schema).option("maxFilesPerTrigger", files_per_trigger).parquet(feed_path)
        .withColumn("ts", F.col("ts").cast("timestamp"))
        .withWatermark("ts", watermark)
    )
    dims = inventory.select("product_id", "quantity_on_hand", "reorder_point").join(
        product.select("product_id", "product_name"), "product_id", "left"
    )
    enriched = stream.join(dims, "product_id")
    cols = ["event_id", "quantity_change", "quantity_on_hand", "reorder_point", "product_name"]
    return ordered_fold(enriched, ["product_id"], _alert_fold, "ts", "event_id", cols, ALERT_CARRY, ALERT_SCHEMA)


def run_low_stock_alerts(
    spark: SparkSession, feed_path: str, movement_schema: T.StructType, inventory: DataFrame,
    product: DataFrame, watermark: str = "7 days", late_path: str | None = None,
    files_per_trigger: int = FILES_PER_TRIGGER,
) -> DataFrame:
    """Run X1 to the end of the feed.

    A movement older than the watermark when it arrives goes to the late
    table, with the stock columns joined to it, instead of being folded out
    of order."""
    folder = _folder(spark, "low-stock-alerts")
    alerts = low_stock_alert_stream(spark, feed_path, movement_schema, inventory, product, watermark, files_per_trigger)
    out = _fold_to_end(alerts, folder, ALERT_SCHEMA.fieldNames(), "ts", late_path)
    return out.withColumn("alert_date", F.timestamp_micros("alert_us").cast("timestamp_ntz")).drop("alert_us")


# ------------------------------------------------------------------ X2 ----
AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("audit_id", T.LongType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("action", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("record_id", T.LongType()),
        T.StructField("old_values", T.StringType()),
        T.StructField("new_values", T.StringType()),
        T.StructField("ip_address", T.StringType()),
        T.StructField("user_agent", T.StringType()),
        T.StructField("occurred_us", T.LongType()),
    ]
)


def _all_rows(rows: DataFrame) -> DataFrame:
    return rows


class CustomerAudit:
    """Audit rows of a feed of customer versions, kept current by micro-batches.

    The watermark is the newest event time of the batches before, less the
    delay. A version older than it goes to the late table; the others wait in
    the version table and are applied, in version-time order, by the batch
    that moves the watermark past them: each is compared (NULL-safe) with the
    one before it, the first of a batch with the customer's last applied
    image, and an audit row is written where any column differs. A customer's
    first version is an insert. All tables are batch folders (``BatchLog``), so
    a replayed batch reads the same state and rewrites its own folders.

    A batch is one grouped pass over its versions and the last images, with no
    work per customer outside of Spark's own operators.
    """

    def __init__(self, spark: SparkSession, folder: str, version_schema: T.StructType, user: str,
                 ip: str = "", agent: str = "", watermark: str = "2 days", compact_every: int = 20) -> None:
        self.spark, self.user, self.ip, self.agent, self.compact_every = spark, user, ip, agent, compact_every
        self.compare = [f.name for f in version_schema.fields if f.name not in ("customer_id", "version_ts")]
        delay = spark.sql(f"SELECT INTERVAL {watermark}").first()[0]
        self.delay_us = delay // dt.timedelta(microseconds=1)
        types = {f.name: f.dataType.simpleString() for f in version_schema.fields} | {"version_ts": "timestamp"}
        version = ", ".join(f"`{c}` {types[c]}" for c in ("customer_id", *self.compare, "version_ts"))
        self.clock = BatchLog(spark, folder + "/clock", "newest_us long", lambda rows: rows.agg(F.max("newest_us").alias("newest_us")))
        self.versions = BatchLog(spark, folder + "/versions", version, _all_rows)
        self.images = BatchLog(spark, folder + "/images", version, self._last_images)
        self.late = BatchLog(spark, folder + "/late", version, _all_rows)
        audit = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in AUDIT_SCHEMA.fields)
        self.audits = BatchLog(spark, folder + "/audits", audit, _all_rows)

    def _last_images(self, rows: DataFrame) -> DataFrame:
        last = rows.groupBy("customer_id").agg(F.max(F.struct("version_ts", *self.compare)).alias("_v"))
        return last.select("customer_id", *(f"_v.{c}" for c in self.compare), "_v.version_ts")

    def _watermark_us(self, before: int) -> int:
        """The watermark as of before a batch, in whole milliseconds as Spark keeps it."""
        newest = self.clock.read(before).first()
        if newest is None or newest[0] is None:
            return 0
        return max(0, (newest[0] - self.delay_us) // 1000 * 1000)

    def _image(self, source: str = "") -> Column:
        fields = [F.col(source + c).alias(c) if c in self.compare else F.lit(None).cast("string").alias(c) for c in TRACKED]
        return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})

    def apply(self, versions: DataFrame, batch_id: int) -> None:
        at = F.unix_micros("version_ts")
        newest = versions.agg(F.max(at).alias("newest_us"))
        self.clock.append(newest, batch_id)
        passed, reached = self._watermark_us(batch_id), self._watermark_us(batch_id + 1)
        rows = versions.filter(F.col("version_ts") < _end())  # without the end-of-input marker
        self.late.append(rows.filter(at < passed), batch_id)
        self.versions.append(rows.filter(at >= passed), batch_id)
        ready = self.versions.read(batch_id + 1).filter((at >= passed) & (at < reached))
        # the last images are older than every version that is applied now
        steps = ready.withColumn("_new", F.lit(True)).unionByName(self.images.read(batch_id).withColumn("_new", F.lit(False)))
        image = F.struct(*self.compare)
        in_order = Window.partitionBy("customer_id").orderBy("version_ts", *self.compare)
        steps = steps.withColumn("_was", F.lag(image).over(in_order))
        changed = steps.filter(F.col("_new") & F.col("_was").isNotNull() & ~F.col("_was").eqNullSafe(image))
        self.audits.append(
            changed.select(
                F.col("customer_id").cast("long").alias("audit_id"), F.lit(self.user).alias("user_id"),
                F.lit("UPDATE").alias("action"), F.lit("customer").alias("table_name"),
                F.col("customer_id").cast("long").alias("record_id"), self._image("_was.").alias("old_values"),
                self._image().alias("new_values"), F.lit(self.ip).alias("ip_address"),
                F.lit(self.agent).alias("user_agent"), at.alias("occurred_us"),
            ),
            batch_id,
        )
        self.images.append(self._last_images(ready), batch_id)
        if self.compact_every and batch_id and batch_id % self.compact_every == 0:
            # up to the batch before: this one may still be replayed
            self.versions.compact(batch_id - 1, keep=at >= passed)
            self.images.compact(batch_id - 1)
            self.clock.compact(batch_id - 1)


def run_customer_audit(
    spark: SparkSession, feed_path: str, version_schema: T.StructType, user: str,
    ip: str = "", agent: str = "", watermark: str = "2 days", late_path: str | None = None,
    files_per_trigger: int = FILES_PER_TRIGGER,
) -> DataFrame:
    """Customer row versions -> one audit row per changed version, kept
    current by ``CustomerAudit``. A version older than the watermark when it
    arrives goes to the late table."""
    folder = _folder(spark, "customer-audit")
    stream = spark.readStream.schema(version_schema).option("maxFilesPerTrigger", files_per_trigger).parquet(feed_path)
    table = CustomerAudit(spark, folder + "/table", version_schema, user, ip, agent, watermark)
    _run_to_end(
        stream.withColumn("version_ts", F.col("version_ts").cast("timestamp"))
        .writeStream.foreachBatch(table.apply).option("checkpointLocation", folder + "/_checkpoint").start()
    )
    late = table.late.read().withColumn("version_ts", F.col("version_ts").cast("timestamp_ntz"))
    late.write.mode("overwrite").parquet(late_path or folder + "/late")
    return table.audits.read().withColumn("occurred_at", F.timestamp_micros("occurred_us").cast("timestamp_ntz")).drop("occurred_us")


# ------------------------------------------------------------------ X3 ----
ORDER_STATE = "order_id long, customer_id long, order_date timestamp, version_ts timestamp, counted decimal(18,2)"
CUSTOMER_CHANGE = "customer_id long, amount decimal(28,2), last timestamp"


def latest_versions(rows: DataFrame) -> DataFrame:
    """The newest version of each order; of equal times the largest row."""
    newest = F.max(F.struct("version_ts", "customer_id", "order_date", "counted")).alias("_v")
    return rows.groupBy("order_id").agg(newest).select("order_id", "_v.customer_id", "_v.order_date", "_v.version_ts", "_v.counted")


def customer_totals(rows: DataFrame) -> DataFrame:
    """Changes (customer_id, amount, last) added up."""
    return rows.groupBy("customer_id").agg(F.sum("amount").cast("decimal(28,2)").alias("amount"), F.max("last").alias("last"))


class LifetimeValue:
    """Customer lifetime value kept current from a feed of order versions.

    Two tables in batch folders (``BatchLog``): the newest version of each
    order with the amount that it counts, and the changes of each customer's
    total. A micro-batch compares its orders with the order table as it was
    before the batch and writes the differences: a cancelled order takes its
    amount back, an order that moves to another customer takes it along, and
    a version that is not newer than the known one (a repeated or overtaken
    delivery) changes nothing. A replayed batch reads the same state and
    rewrites its own folders. Versions may come in any order.

    With ``open_for`` days an order is closed once a version that much younger
    than its order date was seen in an earlier batch: the order table drops it
    at the next compaction, and versions that still come go to the late table.
    """

    def __init__(self, spark: SparkSession, folder: str, excluded=("Cancelled", "Returned"),
                 compact_every: int = 20, open_for: int | None = None) -> None:
        self.spark, self.excluded, self.compact_every, self.open_for = spark, list(excluded), compact_every, open_for
        self.orders = BatchLog(spark, folder + "/orders", ORDER_STATE, latest_versions)
        self.customers = BatchLog(spark, folder + "/customers", CUSTOMER_CHANGE, customer_totals)
        self.late = BatchLog(spark, folder + "/late", ORDER_STATE, lambda rows: rows)

    def _closed(self, rows: DataFrame, before: int) -> Column:
        """Whether an order was closed before a batch."""
        if self.open_for is None:
            return F.lit(False)
        newest = self.orders.read(before).agg(F.max("version_ts")).first()[0]
        if newest is None:
            return F.lit(False)
        return F.col("order_date") < F.lit(newest - dt.timedelta(days=self.open_for))

    def apply(self, versions: DataFrame, batch_id: int) -> None:
        counted = F.when(F.col("order_status").isin(self.excluded), F.lit(0)).otherwise(F.coalesce("total_amount", F.lit(0)))
        rows = versions.select("order_id", "customer_id", "order_date", "version_ts", counted.cast("decimal(18,2)").alias("counted"))
        closed = self._closed(rows, batch_id)
        if self.open_for is not None:
            self.late.append(rows.filter(closed), batch_id)
        known = self.orders.read(batch_id).select("order_id", F.struct("version_ts", "customer_id", "order_date", "counted").alias("was"))
        now = F.struct("version_ts", "customer_id", "order_date", "counted")
        news = latest_versions(rows.filter(~closed)).join(known, "order_id", "left").filter(F.col("was").isNull() | (now > F.col("was")))
        changes = self.orders.append(news, batch_id, extra="was struct<version_ts timestamp, customer_id long, order_date timestamp, counted decimal(18,2)>")
        back = changes.filter("was is not null").select("was.customer_id", (-F.col("was.counted")).alias("amount"), F.lit(None).cast("timestamp").alias("last"))
        there = changes.select("customer_id", F.col("counted").alias("amount"), F.col("order_date").alias("last"))
        self.customers.append(customer_totals(there.unionByName(back)), batch_id)
        if self.compact_every and batch_id and batch_id % self.compact_every == 0:
            # up to the batch before: this one may still be replayed
            self.orders.compact(batch_id - 1, keep=~self._closed(self.orders.read(batch_id), batch_id))
            self.customers.compact(batch_id - 1)

    def totals(self) -> DataFrame:
        return self.customers.read().select(
            "customer_id", F.col("amount").cast("decimal(12,2)").alias("total_lifetime_value"),
            F.col("last").cast("timestamp_ntz").alias("last_purchase_date"),
        )


def run_lifetime_value(
    spark: SparkSession, feed_path: str, order_schema: T.StructType, excluded=("Cancelled", "Returned"),
    files_per_trigger: int = FILES_PER_TRIGGER, compact_every: int = 20, open_for: int | None = None, folder: str | None = None,
) -> DataFrame:
    """A feed of order versions (an order row and its ``version_ts``) ->
    customer lifetime value, kept current by ``LifetimeValue``. A job started
    again on the same ``folder`` goes on where it ended."""
    folder = folder or _folder(spark, "lifetime-value")
    stream = spark.readStream.schema(order_schema).option("maxFilesPerTrigger", files_per_trigger).parquet(feed_path)
    times = {c: F.col(c).cast("timestamp") for c in ("order_date", "version_ts")}
    table = LifetimeValue(spark, folder + "/table", excluded, compact_every, open_for)
    _run_to_end(
        stream.withColumns(times).filter(F.col("version_ts") < _end())
        .writeStream.foreachBatch(table.apply).option("checkpointLocation", folder + "/_checkpoint").start()
    )
    return table.totals()

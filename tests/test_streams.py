"""Streams equal their batch forms; late input is accounted for, not silently lost."""

import datetime as dt
import os
import tempfile
from decimal import Decimal

from pyspark.sql import functions as F

from conftest import SF0001
from stockroom.operators import rules
from stockroom.sources.fixtures import Fixtures
from stockroom.streaming import feeds, jobs
from stockroom.streaming.batch_log import BatchLog

DAY = 86400


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def test_arrival_order():
    assert feeds.arrival_order(5) == [1, 0, 3, 2, 4]


def _feed(moves, slice_days, **how):
    d = tempfile.mkdtemp(prefix="stockroom-feed-", dir="/tmp")
    feeds.write_sliced_feed(moves, d + "/feed", "ts", slice_days * DAY, marker={"event_id": -1, "product_id": -1, "quantity_change": 0}, **how)
    return d


def _slice(moves, k, days):
    epoch = F.unix_timestamp(F.col("ts").cast("timestamp"))
    lo = moves.agg(F.min(epoch)).first()[0]
    return moves.filter(((epoch - F.lit(lo)) / (days * DAY)).cast("int") == k)


COLUMNS = ["alert_id", "product_id", "alert_level", "current_quantity", "message"]


def test_late_rows_are_kept_and_the_rest_equals_batch(spark):
    f = Fixtures(spark, SF0001)
    moves = f.stock_movements
    # slice 0 arrives after slices 1 and 2 with a 1-day watermark: all of it
    # is behind the watermark by then
    d = _feed(moves, 5, order=[1, 2, 0, 3, 4, 5, 6])
    alerts = jobs.run_low_stock_alerts(spark, d + "/feed", moves.schema, f.inventory, f.product,
                                       watermark="1 day", late_path=d + "/late", files_per_trigger=1)
    known = moves.join(f.inventory.select("product_id"), "product_id", "left_semi")
    slice0 = _slice(known, 0, 5)
    late = spark.read.parquet(d + "/late")
    assert _rows(late, moves.columns) == _rows(slice0, moves.columns) and late.count() > 0
    on_time = moves.join(slice0.select("event_id"), "event_id", "left_anti")
    assert _rows(alerts, COLUMNS) == _rows(rules.movement_alerts(on_time, f.inventory, f.product), COLUMNS)


def test_rows_are_on_time_or_late_in_any_order(spark):
    """Whatever the arrival order, the output is the batch form over the rows
    that are not in the late table."""
    f = Fixtures(spark, SF0001)
    moves = f.stock_movements
    d = _feed(moves, 3, order=[4, 0, 2, 1, 6, 3, 5, 9, 8, 7, 10])
    alerts = jobs.run_low_stock_alerts(spark, d + "/feed", moves.schema, f.inventory, f.product,
                                       watermark="4 days", late_path=d + "/late", files_per_trigger=1)
    late = spark.read.parquet(d + "/late")
    assert late.count() > 0
    on_time = moves.join(late.select("event_id"), "event_id", "left_anti")
    assert _rows(alerts, COLUMNS) == _rows(rules.movement_alerts(on_time, f.inventory, f.product), COLUMNS)


def test_in_order_feed_has_no_late_rows(spark):
    f = Fixtures(spark, SF0001)
    moves = f.stock_movements
    d = _feed(moves, 5)
    alerts = jobs.run_low_stock_alerts(spark, d + "/feed", moves.schema, f.inventory, f.product,
                                       watermark="11 days", late_path=d + "/late")
    assert spark.read.parquet(d + "/late").count() == 0
    assert _rows(alerts, COLUMNS) == _rows(rules.movement_alerts(moves, f.inventory, f.product), COLUMNS)


def test_late_versions_of_customers(spark):
    """A version that arrives behind the watermark is set aside; the audit
    compares the versions around it with each other."""
    import datetime as dt

    schema = "customer_id long, full_name string, email string, version_ts timestamp_ntz"

    def day(n):
        return dt.datetime(2020, 1, 1) + dt.timedelta(days=n)

    rows = [(1, "A", "a", day(0)), (1, "A", "b", day(5)), (1, "A", "late", day(2)), (2, None, "x", day(0)), (2, None, None, day(6)), (1, "B", "b", day(9))]
    versions = spark.createDataFrame(rows, schema)
    d = tempfile.mkdtemp(prefix="stockroom-feed-", dir="/tmp")
    feeds.write_sliced_feed(versions, d + "/feed", "version_ts", DAY, marker={"customer_id": -1}, order=[0, 5, 6, 2, 9])
    out = jobs.run_customer_audit(spark, d + "/feed", versions.schema, "u", watermark="2 days", late_path=d + "/late", files_per_trigger=1)
    assert [tuple(r) for r in spark.read.parquet(d + "/late").select(*versions.columns).collect()] == [rows[2]]
    found = sorted((r["record_id"], r["occurred_at"], r["old_values"], r["new_values"]) for r in out.collect())
    assert [(r[0], r[1]) for r in found] == [(1, day(5)), (1, day(9)), (2, day(6))]
    assert '"email":"a"' in found[0][2] and '"email":"b"' in found[0][3] and '"email":null' in found[2][3]


def test_customer_audit_replays_and_compacts(spark):
    """Every batch is delivered twice; versions wait for the watermark, equal
    ones give no audit row, and the last image outlives the compactions."""
    schema = "customer_id long, full_name string, email string, is_active boolean, version_ts timestamp"

    def day(n):
        return dt.datetime(2020, 1, 1) + dt.timedelta(days=n)

    def version(c, email, n, active=True):
        return (c, None, email, active, day(n))

    frames = lambda rows: spark.createDataFrame(rows, schema)
    table = jobs.CustomerAudit(spark, tempfile.mkdtemp(prefix="stockroom-audit-", dir="/tmp") + "/t", frames([]).schema, "u", compact_every=1)
    batches = [
        [version(1, "a", 3), version(2, None, 1)],
        [version(1, "b", 2), version(2, "x", 5), version(2, "x", 4)],
        [version(1, "z", 2), version(1, "b", 8)],  # day 2 is behind the watermark of day 3
        [],
        [version(1, "b", 9, active=False), (-1, None, None, None, feeds.END_OF_INPUT)],
    ]
    expect = [set(), set(), {(1, 3), (2, 4)}, {(1, 3), (2, 4)}, {(1, 3), (2, 4), (1, 8), (1, 9)}]
    for n, (rows, goal) in enumerate(zip(batches, expect, strict=True)):
        for _ in range(2):
            table.apply(frames(rows), n)
            found = [(r["record_id"], (r["occurred_us"] // 1_000_000 - int(day(0).replace(tzinfo=dt.timezone.utc).timestamp())) // DAY) for r in table.audits.read().collect()]
            assert sorted(found) == sorted(goal)
    assert [(r["customer_id"], r["email"]) for r in table.late.read().collect()] == [(1, "z")]
    assert len(table.images._parts(None)[1]) <= 3
    last = table.audits.read().filter("record_id = 2").first()
    assert last["old_values"] == '{"full_name":null,"email":null,"phone":null,"shipping_address":null}' and '"email":"x"' in last["new_values"]


def test_customer_audit_runs_no_code_per_customer(spark):
    """Many customers cost one grouped pass, and equal the batch form."""
    before = spark.range(20_000).select(
        F.col("id").alias("customer_id"), F.lit("n").alias("full_name"), F.concat(F.lit("e"), "id").alias("email"))
    after = before.withColumn("email", F.when(F.col("customer_id") % 9 == 0, F.lit("new")).otherwise(F.col("email")))
    first, second = dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 2)
    versions = before.withColumn("version_ts", F.lit(first).cast("timestamp_ntz")).unionByName(
        after.withColumn("version_ts", F.lit(second).cast("timestamp_ntz")))
    d = tempfile.mkdtemp(prefix="stockroom-feed-", dir="/tmp")
    feeds.write_sliced_feed(versions, d + "/feed", "version_ts", DAY, marker={"customer_id": -1})
    out = jobs.run_customer_audit(spark, d + "/feed", versions.schema, "u", late_path=d + "/late", files_per_trigger=1)
    goal = rules.customer_change_audit(before, after, second, "u")
    assert _rows(out, goal.columns) == _rows(goal, goal.columns) and out.count() == 2223
    assert not os.path.exists(os.path.join(os.path.dirname(out.inputFiles()[0].removeprefix("file:")), "../../_checkpoint/state"))


def test_non_utc_session_zone(spark):
    f = Fixtures(spark, SF0001)
    moves = f.stock_movements
    d = tempfile.mkdtemp(prefix="stockroom-feed-", dir="/tmp")
    feeds.write_sliced_feed(moves, d + "/feed", "ts", 5 * DAY,
                            marker={"event_id": -1, "product_id": -1, "quantity_change": 0})
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        alerts = jobs.run_low_stock_alerts(spark, d + "/feed", moves.schema, f.inventory, f.product,
                                           watermark="11 days")
        cols = ["alert_id", "product_id", "alert_level", "current_quantity", "message", "alert_date"]
        assert _rows(alerts, cols) == _rows(rules.movement_alerts(moves, f.inventory, f.product), cols)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def _versions(spark, rows):
    schema = "order_id long, customer_id long, order_date timestamp, total_amount decimal(10,2), order_status string, version_ts timestamp"
    day = dt.datetime(2020, 1, 1)
    return spark.createDataFrame(
        [(o, c, day + dt.timedelta(days=d), Decimal(a), s, day + dt.timedelta(days=v)) for o, c, d, a, s, v in rows], schema)


def _totals(table):
    return sorted((r["customer_id"], r["total_lifetime_value"], r["last_purchase_date"].toordinal() - dt.datetime(2020, 1, 1).toordinal()) for r in table.totals().collect())


def test_lifetime_value_takes_back_and_moves(spark):
    """Cancelled, re-opened, moved, repeated and overtaken versions."""
    table = jobs.LifetimeValue(spark, tempfile.mkdtemp(prefix="stockroom-ltv-", dir="/tmp") + "/t", compact_every=2)
    batches = [
        [(1, 10, 0, "5", "Pending", 0), (2, 10, 1, "7", "Pending", 1), (3, 11, 2, "9", "Returned", 6)],
        [(1, 10, 0, "5", "Cancelled", 3), (3, 11, 2, "9", "Shipped", 2), (2, 10, 1, "7", "Pending", 1)],  # 3: overtaken
        [(2, 12, 1, "7", "Pending", 4), (4, 12, 5, "1.50", "Pending", 5), (4, 12, 5, "2.50", "Pending", 6)],
        [(1, 10, 0, "5", "Shipped", 8), (5, 13, 9, "4", "Cancelled", 9)],
        [],
        [(5, 13, 9, "4", "Delivered", 10)],
    ]
    expect = [
        [(10, Decimal(12), 1), (11, Decimal(0), 2)],
        [(10, Decimal(7), 1), (11, Decimal(0), 2)],
        [(10, Decimal(0), 1), (11, Decimal(0), 2), (12, Decimal("9.50"), 5)],
        [(10, Decimal(5), 1), (11, Decimal(0), 2), (12, Decimal("9.50"), 5), (13, Decimal(0), 9)],
    ]
    expect += [expect[3], [*expect[3][:3], (13, Decimal(4), 9)]]
    for n, (rows, goal) in enumerate(zip(batches, expect, strict=True)):
        for _ in range(2):  # every batch is replayed
            table.apply(_versions(spark, rows), n)
            assert _totals(table) == goal
    fresh = jobs.LifetimeValue(spark, table.orders.path.removesuffix("/orders"))  # a new driver
    assert _totals(fresh) == expect[-1]
    assert len(fresh.orders._parts(None)[1]) <= 3  # one base and what came after it


def test_closed_orders_go_to_the_late_table(spark):
    table = jobs.LifetimeValue(spark, tempfile.mkdtemp(prefix="stockroom-ltv-", dir="/tmp") + "/t", compact_every=1, open_for=10)
    table.apply(_versions(spark, [(1, 10, 0, "5", "Pending", 0), (2, 10, 20, "7", "Pending", 20)]), 0)
    table.apply(_versions(spark, [(1, 10, 0, "5", "Cancelled", 21), (2, 10, 20, "7", "Cancelled", 22), (3, 10, 30, "1", "Pending", 31)]), 1)
    table.apply(_versions(spark, [(3, 10, 30, "1", "Shipped", 32)]), 2)
    assert _totals(table) == [(10, Decimal(6), 30)]
    assert [r["order_id"] for r in table.late.read().collect()] == [1]
    assert sorted(r["order_id"] for r in table.orders.read().collect()) == [3]  # closed orders are forgotten


def test_crash_between_base_and_switch(spark):
    """A base without its _SUCCESS file is not read and the batches stay in use."""
    log = BatchLog(spark, tempfile.mkdtemp(prefix="stockroom-log-", dir="/tmp") + "/t", "k long, v long",
                   lambda rows: rows.groupBy("k").agg(F.sum("v").alias("v")))
    assert log.read().collect() == []

    def table(before=None):
        return sorted(tuple(r) for r in log.read(before).collect())

    for n in range(5):
        log.append(spark.createDataFrame([(1, 1), (n, 10)], "k long, v long"), n)
    whole, early = table(), table(3)
    assert early == [(0, 10), (1, 13), (2, 10)]
    log.compact(1)
    assert table() == whole and table(3) == early and len(log._parts(None)[1]) == 4
    log.compact(3)
    os.rename(log._folder("base", 3) + "/_SUCCESS", log._folder("base", 3) + "/_gone")  # the crash
    assert table() == whole and len(log._parts(None)[1]) == 4
    log.compact(3)  # done again
    log.compact(4)
    assert table() == whole and log._parts(None)[1] == [log._folder("base", 4)]


def test_slices_of_several_files(spark):
    rows = spark.range(95).select(F.col("id").alias("event_id"), F.timestamp_seconds(F.col("id") * 3600).cast("timestamp_ntz").alias("ts"))
    d = tempfile.mkdtemp(prefix="stockroom-feed-", dir="/tmp")
    width = feeds.write_sliced_feed(rows, d + "/feed", "ts", DAY, marker={"event_id": -1}, rows_per_file=7)
    assert width == 4 and feeds._files(spark, d + "/feed") == 5 * width
    assert spark.read.parquet(d + "/feed").count() == 96

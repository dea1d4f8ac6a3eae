"""O5 allocation equals the reference's one-order-at-a-time loop."""

import datetime as dt
import random

from stockroom.operators.allocate import allocate_lines, allocation_outcomes
from stockroom.plans.order_batch import order_batch
from stockroom.sources.fixtures import Fixtures

from conftest import SF0001

T0 = dt.datetime(2024, 1, 1)


def serial(orders, stock):
    """orders: [(request_id, ts, {product: qty})] -> {request_id: accepted}."""
    left = dict(stock)
    out = {}
    for rid, _, lines in sorted(orders, key=lambda o: (o[1], o[0])):
        ok = all(q <= left[p] for p, q in lines.items())
        out[rid] = ok
        if ok:
            for p, q in lines.items():
                left[p] -= q
    return out


def _random_cases(n_cases, seed):
    rnd = random.Random(seed)
    all_orders, stock, expect = [], {}, {}
    rid = 0
    for case in range(n_cases):
        base = case * 100
        prods = list(range(base, base + rnd.randint(1, 4)))
        st = {p: rnd.randint(0, 12) for p in prods}
        orders = []
        for _ in range(rnd.randint(1, 12)):
            rid += 1
            k = rnd.randint(1, len(prods))
            lines = {p: rnd.randint(1, 6) for p in rnd.sample(prods, k)}
            # same-time ties are broken by request id
            orders.append((rid, T0 + dt.timedelta(hours=rnd.randint(0, 5)), lines))
        stock.update(st)
        expect.update(serial(orders, st))
        all_orders.extend(orders)
    return all_orders, stock, expect


import pytest
from pyspark.sql import functions as F


@pytest.mark.parametrize("hot,rounds", [(1_000_000, 1), (1_000_000, 2), (0, 1), (0, 3)])
def test_random_cases_match_serial(spark, hot, rounds):
    """hot=0 forces the two-level running sums; several rounds a stage."""
    orders, stock, expect = _random_cases(300, seed=7 + hot % 5)
    lines = spark.createDataFrame(
        [(rid, ts, p, q) for rid, ts, ls in orders for p, q in ls.items()],
        "request_id long, request_ts timestamp_ntz, product_id long, quantity int",
    )
    inv = spark.createDataFrame(list(stock.items()), "product_id long, quantity_available int")
    stats = []
    alloc = allocate_lines(lines, inv, stats=stats, hot_product_lines=hot, rounds_per_stage=rounds)
    got = {r["request_id"]: r["accepted"] for r in allocation_outcomes(alloc).collect()}
    assert got == expect
    assert stats[-1]["open_lines"] == 0
    assert stats[-1]["two_level"] == (hot == 0)


def test_hot_product_chain_and_messages(spark):
    # one hot product shared by every order, stock runs out half-way
    orders = [(i, T0 + dt.timedelta(minutes=i), {1: 1, 100 + i: 1}) for i in range(1, 41)]
    stock = {1: 20, **{100 + i: 1 for i in range(1, 41)}}
    lines = spark.createDataFrame(
        [(rid, ts, p, q) for rid, ts, ls in orders for p, q in ls.items()],
        "request_id long, request_ts timestamp_ntz, product_id long, quantity int",
    )
    inv = spark.createDataFrame(list(stock.items()), "product_id long, quantity_available int")
    out = {r["request_id"]: r for r in allocation_outcomes(allocate_lines(lines, inv)).collect()}
    assert [i for i in out if out[i]["accepted"]] == list(range(1, 21)) or sorted(
        i for i in out if out[i]["accepted"]) == list(range(1, 21))
    assert (out[21]["short_product_id"], out[21]["requested"], out[21]["available"]) == (1, 1, 0)


def test_sf0001_matches_serial(spark):
    f = Fixtures(spark, SF0001)
    b = order_batch(f.order_requests, f.customer, f.product, f.inventory, f.promotions)
    alloc = b.allocated.select("request_id", "request_ts", "product_id", "quantity", "stock", "accepted").toPandas()
    stock = dict(zip(alloc["product_id"], alloc["stock"]))
    orders = [
        (rid, g["request_ts"].iloc[0], dict(zip(g["product_id"], g["quantity"])))
        for rid, g in alloc.groupby("request_id")
    ]
    expect = serial(orders, stock)
    got = dict(zip(alloc["request_id"], alloc["accepted"]))
    assert got == expect
    assert 0 < sum(expect.values()) < len(expect)


def test_chain_is_decided_to_its_end(spark):
    # order i shares product i with order i+1: each round settles the head of
    # the chain only, and the loop goes on until all orders are decided
    orders = [(i, T0 + dt.timedelta(minutes=i), {i: 1, i + 1: 1}) for i in range(1, 12)]
    stock = {p: 1 for p in range(1, 13)}
    lines = spark.createDataFrame(
        [(rid, ts, p, q) for rid, ts, ls in orders for p, q in ls.items()],
        "request_id long, request_ts timestamp_ntz, product_id long, quantity int",
    )
    inv = spark.createDataFrame(list(stock.items()), "product_id long, quantity_available int")
    stats = []
    out = {r["request_id"]: r["accepted"] for r in allocation_outcomes(allocate_lines(lines, inv, stats=stats)).collect()}
    assert out == serial(orders, stock)
    assert len(stats) > 2 and stats[-1]["open_lines"] == 0


@pytest.mark.parametrize("hot", [False, True])
def test_guarded_updates_equal_the_serial_loop(spark, monkeypatch, hot):
    """Updates that would make stock negative are refused one by one; one
    product holds most updates."""
    from stockroom.functions import windows
    from stockroom.operators import rules

    if hot:  # range buckets for every running sum
        monkeypatch.setattr(rules, "bucket_mode", lambda *a, **k: windows.RANGE)
        monkeypatch.setattr(rules.allocate_lines, "__defaults__", (None, (), 0, 2))
    draw = random.Random(13)
    stock = {1: 30, 2: 0, 3: 5, 4: 7}
    rows = [(k, draw.randrange(40), draw.choice([1, 1, 1, 1, 2, 3, 9]), draw.choice([-25, -9, -4, -1, 0, 2, 6])) for k in range(250)]
    updates = spark.createDataFrame(rows, "update_id long, ts long, product_id long, quantity_change int").repartition(4)
    inventory = spark.createDataFrame([(p, q) for p, q in stock.items()], "product_id long, quantity_on_hand int")
    expect, level = {}, dict(stock)
    for k, t, p, q in sorted(rows, key=lambda r: (r[1], r[0])):
        if p in level:
            fits = level[p] + q >= 0
            level[p] += q if fits else 0
            expect[k] = (t, p, fits, level[p])
    got = {r["update_id"]: (r["ts"], r["product_id"], r["applied"], r["level"]) for r in rules.guarded_updates(inventory, updates).collect()}
    assert got == expect and not all(v[2] for v in expect.values())


def test_orders_of_one_line_need_no_rounds(spark):
    """A chain of single lines, each decided by the one before it, takes one
    ordered pass; orders with two lines among them go back to the rounds."""
    lines = [(i, T0 + dt.timedelta(minutes=i), 1, 3 if i % 2 else 2) for i in range(60)]
    schema = "request_id long, request_ts timestamp_ntz, product_id long, quantity int"
    inv = spark.createDataFrame([(1, 40), (2, 5)], "product_id long, quantity_available int")
    for more, rounds in (([], False), ([(3, T0 + dt.timedelta(minutes=3), 2, 6)], True)):
        rows, stats = lines + more, []
        out = allocate_lines(spark.createDataFrame(rows, schema).repartition(3), inv, stats=stats, one_line=True)
        orders = {}
        for rid, ts, p, q in rows:
            orders.setdefault(rid, (rid, ts, {}))[2][p] = q
        expect = serial(list(orders.values()), {1: 40, 2: 5})
        assert {r["request_id"]: r["accepted"] for r in out.collect()} == expect and 0 < sum(expect.values()) < 60
        assert bool(stats) == rounds


def test_only_lines_of_tight_products_enter_the_loop(spark):
    f = Fixtures(spark, SF0001)
    stock = f.inventory_ample.withColumn(
        "quantity_available", F.when(F.col("product_id") % 9 == 4, 60).otherwise(F.col("quantity_available")))
    b = order_batch(f.order_requests, f.customer, f.product, stock, f.promotions)
    assert b.tight_lines.select("product_id").distinct().count() < f.inventory.count() / 2
    got = {r["request_id"]: r["accepted"] for r in b.outcomes.collect()}
    alloc = b.allocated.select("request_id", "request_ts", "product_id", "quantity", "stock", "accepted").toPandas()
    orders = [(rid, g["request_ts"].iloc[0], dict(zip(g["product_id"], g["quantity"]))) for rid, g in alloc.groupby("request_id")]
    expect = serial(orders, dict(zip(alloc["product_id"], alloc["stock"])))
    assert got == expect and dict(zip(alloc["request_id"], alloc["accepted"])) == expect
    assert 0 < sum(expect.values()) < len(expect)

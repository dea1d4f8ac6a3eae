"""The hot-key (range bucket) plans equal the normal plans on real queries.

Test data never holds a key above the hot bound, so the range-bucket path
is forced here and compared with the plain path on the same fixtures.
"""

import functools

import pytest

from conftest import SF0001
from stockroom.functions import windows
from stockroom.operators import allocate, kpis, restock, returns, rules
from stockroom.plans import order_batch, registry

QUERIES = [
    "customer_order_frequency",
    "category_sales_rank",
    "movement_alerts",
    "restock_movements",
    "return_restock",
    "promotion_usage",
    "order_movements",
    "allocate_stock",
]


def _rows(df):
    return sorted(repr(tuple(r)) for r in df.collect())


@pytest.fixture(scope="module")
def plain_results(spark):
    qs = registry.all_queries()
    return {n: _rows(qs[n](spark, SF0001)) for n in QUERIES}


def test_forced_range_buckets_equal_plain(spark, plain_results, monkeypatch):
    force = lambda *a, **k: windows.RANGE
    for module in (kpis, rules, restock, returns, order_batch):
        monkeypatch.setattr(module, "bucket_mode", force)
    monkeypatch.setattr(
        allocate, "allocate_lines", functools.partial(allocate.allocate_lines, hot_product_lines=0)
    )
    calls = []
    real = windows.range_buckets

    def counted(*a, **k):
        calls.append(1)
        return real(*a, **k)

    monkeypatch.setattr(windows, "range_buckets", counted)
    qs = registry.all_queries()
    for name in QUERIES:
        before = len(calls)
        assert _rows(qs[name](spark, SF0001)) == plain_results[name], name
        assert len(calls) > before, f"{name} did not take the range-bucket path"

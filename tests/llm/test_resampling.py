"""Weights against a dictionary model, top-k against a sort."""

import numpy as np
from pyspark.sql import functions as F

from stockroom.llm import resampling as rs
from stockroom.llm.bytehash import ByteHasher

SF0001 = "/root/testdata/sf0.01"

GOOD = "quality = 1"


def test_weights_and_choice(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    labels = spark.read.parquet(f"{SF0001}/labels.parquet")
    hasher = ByteHasher()
    found = {r["doc_id"]: rs.features(r["text"], hasher) for r in docs.collect()}
    good = {r["doc_id"]: r["quality"] == 1 for r in labels.collect()}
    raw, target = np.ones(rs.BUCKETS), np.ones(rs.BUCKETS)
    for k, f in found.items():
        np.add.at(raw, f, 1)
        if good.get(k):
            np.add.at(target, f, 1)
    ratio = np.log(target / target.sum()) - np.log(raw / raw.sum())
    rows = rs.judge(docs, labels, F.expr(GOOD)).collect()
    assert len(rows) == len(found)
    for r in rows:
        assert abs(r["log_weight"] - ratio[found[r["doc_id"]]].sum()) < 1e-6
    share = sum(good.values()) / len(good)
    k = max(round(share * len(rows)), sum(r["log_weight"] > 0 for r in rows))
    best = {r["doc_id"] for r in sorted(rows, key=lambda r: -r["noisy"])[:k]}
    assert {r["doc_id"] for r in rows if r["kept"]} == best
    # labelled documents: junk goes, clean documents stay
    kept = {r["doc_id"]: r["kept"] for r in rows}
    assert np.mean([kept[d] for d, g in good.items() if g]) > 0.97
    assert np.mean([kept[d] for d, g in good.items() if not g]) < 0.1
    again = {r["doc_id"] for r in rs.resampled_documents(docs, labels, F.expr(GOOD)).collect()}
    assert again == best


def test_kth_largest(spark):
    values = [5, -3, 2**62, -(2**62), 5, 0, 17, -1]
    bits = spark.createDataFrame([(v,) for v in values], "bits long")
    for k, v in enumerate(sorted(values, reverse=True), 1):
        assert rs.kth_largest(bits, k) == v


def test_sortable_order():
    x = np.array([-np.inf, -1e300, -1.5, -1e-300, 0.0, 1e-300, 2.5, np.inf])
    assert (np.diff(rs.sortable(x)) > 0).all()


def test_odd_rows(spark, clashing_docs, odd_rows, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (7, 0, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    rows = rs.judge(clashing_docs, labels, F.expr(GOOD)).collect()
    assert len(rows) == len(odd_rows)
    twins = [r for r in rows if r["doc_id"] == 1]
    assert twins[0]["noisy"] == twins[1]["noisy"] and twins[0]["kept"] == twins[1]["kept"]
    none = labels.filter("false")
    assert all(r["kept"] for r in rs.judge(clashing_docs, none, F.expr(GOOD)).collect())
    out = rs.resampled_documents(clashing_docs, none, F.expr(GOOD))
    assert out.columns == clashing_docs.columns and out.count() == len(odd_rows)
    assert rs.judge(no_docs, labels, F.expr(GOOD)).count() == 0

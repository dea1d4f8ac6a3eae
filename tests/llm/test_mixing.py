"""Targets against iterative sharing, choices against a sort."""

import hashlib
import re
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from stockroom.llm import mixing

SF001 = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shared(sizes, weights, cap):
    """Share by weight, stop at the cap, share the excess again."""
    target, free = {}, dict(weights)
    left = Fraction(sum(sizes.values()))
    while free:
        total = sum(free.values())
        over = {s for s, w in free.items() if left * w / total > cap * sizes[s]}
        if not over:
            return target | {s: left * w / total for s, w in free.items()}
        for s in over:
            target[s] = Fraction(cap * sizes[s])
            left -= target[s]
            del free[s]
    return target


def position(key):
    return int(hashlib.md5(f"mix:{'' if key is None else key}".encode()).hexdigest()[:15], 16)


def brute(rows):
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(WORD.findall(text or ""))
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    target = shared(sizes, {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}, 3)
    out = []
    for s in order:
        docs = sorted(((position(d), d, len(WORD.findall(t or ""))) for d, t, x in rows if x == s), key=lambda r: r[0])
        passes = int(target[s] // sizes[s]) if sizes[s] else 0
        left = target[s] - passes * sizes[s]
        for h in sorted({r[0] for r in docs}):
            group = [r for r in docs if r[0] == h]
            before = sum(r[2] for r in docs if r[0] < h)
            size = sum(r[2] for r in group)
            extra = 2 * before + size < 2 * left
            out += [(d, n, sizes[s], float(target[s]), n * (passes + extra)) for _, d, n in group]
    return sorted(out, key=repr)


def got(frame):
    return sorted(((r["doc_id"], r["size"], r["source_size"], r["target"], r["taken"]) for r in mixing.mix(frame).collect()), key=repr)


def near(a, b):
    assert len(a) == len(b)
    for x, y in zip(a, b, strict=True):
        assert x[:3] == y[:3] and x[4] == y[4] and x[3] == pytest.approx(y[3], rel=1e-12)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    found = got(docs)
    near(found, brute(rows))
    taken, target, largest = {}, {}, {}
    source = {d: s for d, _, s in rows}
    for d, size, _, t, n in found:
        s = source[d]
        taken[s], target[s], largest[s] = taken.get(s, 0) + n, t, max(size, largest.get(s, 0))
        assert n <= 3 * size
    assert all(abs(taken[s] - target[s]) <= largest[s] / 2 + 1 for s in taken)
    # the rows of the mix are the documents as often as they are taken
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    counts = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert counts == {r["doc_id"]: r["copies"] for r in mixing.mix(docs).filter("copies > 0").collect()}


@pytest.mark.parametrize("sizes", [[1], [10, 1], [1, 1, 1000], [0, 5], [0], [7, 7, 7, 7, 7, 7, 7], [1000, 1, 1, 1, 1]])
def test_targets(spark, sizes):
    names = [f"s{k}" for k in range(len(sizes) - 1)] + [None]
    frame = spark.createDataFrame(list(zip(names, sizes, strict=True)), "source string, source_size long")
    found = {r["source"]: r["target"] for r in mixing.source_targets(frame).collect()}
    truth = shared(dict(zip(names, sizes, strict=True)), {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}, 3)
    assert found == pytest.approx({s: float(t) for s, t in truth.items()})


def test_odd_rows(clashing_docs, odd_rows, no_docs):
    near(got(clashing_docs), brute([(r[0], r[1], r[3]) for r in odd_rows]))
    assert mixing.mixed_documents(clashing_docs).columns == clashing_docs.columns
    assert mixing.mix(no_docs).count() == 0 and mixing.mixed_documents(no_docs).count() == 0


def test_larger_budgets_hold_the_smaller_mix(spark):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.expr("repeat('w ', cast(1 + id % 7 as int))").alias("text"),
                                   F.expr("if(id % 4 = 0, 'b', 'a')").alias("source"))
    small = {r["doc_id"]: r["copies"] for r in mixing.mix(docs, weights=(1, 6)).collect()}
    large = {r["doc_id"]: r["copies"] for r in mixing.mix(docs, weights=(1, 4)).collect()}
    assert all(small[d] <= large[d] for d in small if d % 4)

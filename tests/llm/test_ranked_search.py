"""Ranked lists against a brute-force search."""

import math
import re

import pytest

from stockroom.llm import ranked_search

SF0001 = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(UPPER))


def brute(docs, items, k=20):
    lists = [(d, terms(t)) for d, t in docs]
    n_docs, length = sum(bool(t) for _, t in lists), sum(len(t) for _, t in lists)
    df = {}
    for _, t in lists:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    asked = {}
    for item, text in items:
        asked.setdefault(item, []).extend(terms(text))
    out = []
    for item, wanted in asked.items():
        scores = []
        for d, t in lists:
            m = 75 + (25 * len(t) * n_docs) // length if length else 0
            score = 0
            for x in wanted:
                tf = t.count(x)
                if tf:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1)))
                    score += w * ((10**9 * tf) // (1000 * tf + 12 * m))
            if score > 0:
                scores.append((-score, d is None, d or 0, d))
        scores.sort()
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(scores[:k], 1)]
    return sorted(out, key=repr)


def got(docs, items, **how):
    return sorted((tuple(r) for r in ranked_search.search(docs, items, **how).collect()), key=repr)


def test_whole_table(spark):
    docs, items = (spark.read.parquet(f"{SF0001}/{t}.parquet") for t in ("documents", "benchmark"))
    truth = brute([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in items.collect()])
    assert got(docs, items) == truth
    # items in many blocks, shards of few documents
    assert got(docs.repartition(7), items, block_terms=100) == truth


@pytest.mark.parametrize("k", [1, 3])
def test_few_results_and_tiny_shards(spark, monkeypatch, k):
    rows = [(d, " ".join(w for b, w in enumerate(("red", "green", "blue", "grey", "pink")) if d * 7 % 31 >> b & 1)) for d in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    wanted = [(1, "red green blue"), (2, "pink pink pink grey"), (3, "red green blue grey pink")]
    items = spark.createDataFrame(wanted, "item_id long, text string")
    monkeypatch.setattr(ranked_search, "SHARD_POSTINGS", 4)
    assert got(docs, items, k=k) == brute(rows, wanted, k)


def test_odd_rows(spark, clashing_docs, odd_rows, no_docs):
    wanted = [(1, "quick FOX fox"), (None, "words"), (None, "here word29999"), (2, None), (3, " .,; "), (4, "nowhere"), (5, "ñandú 梦 12"), (1, "lazy")]
    items = spark.createDataFrame([(i, t, "x", 1) for i, t in wanted], "item_id long, text string, id string, term long")
    assert got(clashing_docs, items) == brute([(r[0], r[1]) for r in odd_rows], wanted)
    assert got(no_docs, items) == [] and got(clashing_docs, items.limit(0)) == []
    assert ranked_search.search(no_docs, items).columns == ["item_id", "rank", "doc_id", "score"]


def test_long_text_in_blocks(spark):
    text = " ".join(f"w{i % 999}" for i in range(400_000))  # more than one block of bytes
    docs, wanted = [(1, text), (2, "w1 w2"), (3, "x" * 3_000_000 + " w1")], [(0, "w1 w2 w998")]
    items = spark.createDataFrame(wanted, "item_id long, text string")
    assert got(spark.createDataFrame(docs, "doc_id long, text string"), items) == brute(docs, wanted)


def test_accumulators_are_limited():
    """Once the rest cannot reach the k-th partial score, frequent terms create no accumulator."""
    import numpy as np
    import pyarrow as pa

    n = 1000
    sizes = np.ones(n, dtype=np.int64)
    sizes[:2] = 2
    lists = [[0, 1], [0, 1]] + [[1]] * (n - 2)
    flat = np.array([t for x in lists for t in x])
    plan = ranked_search.Plan([], np.array([9000, 10]), n, int(flat.size))
    shard = ranked_search.Shard(pa.array(range(n)), sizes, sizes, flat, np.ones(flat.size, dtype=np.int64), plan)
    docs, scores = shard.best(np.array([0, 1]), np.array([1, 1]), 2)
    assert sorted(docs.tolist()) == [0, 1] and (scores == 9010 * ((10**9) // (1000 + 12 * (75 + 50 * n // int(flat.size))))).all()

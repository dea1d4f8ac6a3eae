"""Base scores against a Counter, the forward recursion against all paths."""

import itertools
import math
import zlib
from collections import Counter

import numpy as np

from stockroom.llm import hmm

SF0001 = "/root/testdata/sf0.001"


def toy(seed, states=hmm.STATES):
    rng = np.random.default_rng(seed)
    emit = rng.dirichlet(np.ones(hmm.CLASSES), size=states).T
    return hmm.Hmm(rng.dirichlet(np.ones(states)), rng.dirichlet(np.ones(states), size=states), emit)


def by_paths(model, seq):
    total = 0.0
    for path in itertools.product(range(hmm.STATES), repeat=len(seq)):
        p = model.start[path[0]] * model.emit[seq[0], path[0]]
        for (a, b), c in zip(itertools.pairwise(path), seq[1:], strict=True):
            p *= model.move[a, b] * model.emit[c, b]
        total += p
    return math.log(total)


def test_forward_is_the_sum_over_paths():
    model = toy(1)
    docs = [np.array(s, dtype=np.uint16) for s in ([0], [5, 9, 0], [7, 7, 3, 0], [hmm.CLASSES - 1, 0])]
    found = hmm.Lanes(docs, lanes=2).log_likelihoods(model, len(docs))
    assert np.allclose(found, [by_paths(model, d) for d in docs], rtol=1e-10)


def test_expected_counts_raise_the_likelihood():
    rng = np.random.default_rng(2)
    docs = [np.append(rng.integers(1, 40, size=n), 0).astype(np.uint16) for n in (3, 50, 1, 17, 200)]
    model, last = toy(3), -np.inf
    for _ in range(5):
        lanes = hmm.Lanes(docs, lanes=3)
        flat = lanes.expected_counts(model)
        a, b = 1 + hmm.STATES, 1 + hmm.STATES + hmm.STATES**2
        starts, moves, emit = flat[1:a], flat[a:b].reshape(hmm.STATES, -1), flat[b : b + hmm.CLASSES * hmm.STATES].reshape(hmm.CLASSES, -1)
        assert math.isclose(starts.sum(), len(docs)) and math.isclose(emit.sum(), sum(map(len, docs)))
        assert math.isclose(moves.sum(), sum(len(d) - 1 for d in docs))
        assert math.isclose(flat[0], lanes.log_likelihoods(model, len(docs)).sum(), rel_tol=1e-9)
        assert flat[0] >= last - 1e-9
        last = flat[0]
        model = hmm.Hmm(starts / starts.sum(), moves / moves.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def slow_base(docs):
    counts = Counter()
    split = {}
    for i, (d, text) in enumerate(docs):
        split[i] = (text or "").encode().lower().split() + [None]
        if zlib.crc32(str(d).encode() if d is not None else b"") % 7 != 2:
            counts.update(split[i])
    n, v = sum(counts.values()), len(counts)
    return n, [(len(w), sum(counts[x] > 0 for x in w), sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w)) for w in split.values()]


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    n, slow = slow_base(rows)
    # a head of 500 words: the others go through the join
    found = {r["doc_id"]: r for r in hmm.score_documents(docs, rounds=2, head=500).collect()}
    assert len(found) == len(rows)
    for (d, _), (size, known, base) in zip(rows, slow, strict=True):
        r = found[d]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (size, known, n)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9)
        assert r["held_out"] == (zlib.crc32(str(d).encode()) % 7 == 2)
    held = [r for r in found.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_odd_rows(clashing_docs, odd_rows, no_docs):
    _, slow = slow_base([(r[0], r[1]) for r in odd_rows])
    found = hmm.score_documents(clashing_docs, rounds=1).collect()
    assert sorted((r["n_tokens"], r["n_known"], round(r["base_score"], 4)) for r in found) == sorted((a, b, round(c, 4)) for a, b, c in slow)
    assert all(np.isfinite(r["score"]) and r["score"] <= 0 for r in found)
    twins = [r["score"] for r in found if r["doc_id"] == 1]
    assert math.isclose(*twins)
    assert hmm.score_documents(no_docs).count() == 0


def test_the_end_token_outside_the_head(spark):
    """Few long texts: the end is rarer than the head's words. It has a class
    of its own in any case, so the scores do not depend on the head."""
    docs = spark.createDataFrame([(i, "a " * (40 + i)) for i in range(6)], "doc_id long, text string")
    scores = [{r["doc_id"]: (r["score"], r["base_score"]) for r in hmm.score_documents(docs, rounds=2, head=h).collect()} for h in (1, 2)]
    for d, (score, base) in scores[0].items():
        assert math.isclose(score, scores[1][d][0], rel_tol=1e-9) and score < 0
        assert math.isclose(base, scores[1][d][1], rel_tol=1e-9)

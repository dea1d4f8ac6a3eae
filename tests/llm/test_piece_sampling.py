"""Round trips; draws against the enumerated lattice."""

import itertools
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stockroom.llm import piece_sampling as ps

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def encoder():
    return ps.Encoder()


@pytest.fixture(scope="module")
def decoder():
    return ps.Decoder()


def split(flat, sizes):
    ends = np.cumsum(sizes)
    return [flat[e - n : e] for e, n in zip(ends, sizes, strict=True)]


@given(st.lists(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=40), max_size=5))
@settings(max_examples=200, deadline=None)
def test_any_text_comes_back(texts):
    encoder, decoder = ps.Encoder.cached, ps.Decoder.cached
    flat, sizes = encoder.encode(texts, np.arange(len(texts), dtype=np.int64))
    assert [decoder.decode(ids) for ids in split(flat, sizes)] == texts


@pytest.fixture(autouse=True, scope="module")
def _cached(encoder, decoder):
    ps.Encoder.cached, ps.Decoder.cached = encoder, decoder
    yield
    del ps.Encoder.cached, ps.Decoder.cached


def test_draws_do_not_depend_on_the_batch(encoder):
    texts = ["hello there world", "", "the quick brown fox", "ñandú ▁ 😀", "a" * 500]
    keys = np.array([5, 6, 7, 8, -9], dtype=np.int64)
    whole = split(*encoder.encode(texts, keys))
    for k in range(len(texts)):
        alone, _ = encoder.encode(texts[k : k + 1], keys[k : k + 1])
        assert (alone == whole[k]).all()


def test_draws_follow_the_weights(encoder):
    """Share of every segmentation of a word against the product of its
    piece weights over the sum for all segmentations."""
    pieces, word = encoder.pieces, "▁hello"
    import sentencepiece

    vocabulary = sentencepiece.SentencePieceProcessor(model_file=ps.MODEL)
    ids = {vocabulary.id_to_piece(k): k for k in range(vocabulary.get_piece_size())}
    weights = {}
    for cuts in itertools.product([False, True], repeat=len(word) - 1):
        edges = [0, *(i + 1 for i, c in enumerate(cuts) if c), len(word)]
        parts = [word[a:b] for a, b in itertools.pairwise(edges)]
        if all(p in ids for p in parts):
            weights[tuple(ids[p] for p in parts)] = np.exp(sum(pieces.log_weight[ids[p]] for p in parts))
    n = 40_000
    drawn = Counter(tuple(x.tolist()) for x in split(*encoder.encode(["hello"] * n, np.arange(n, dtype=np.int64))))
    assert set(drawn) <= set(weights)
    total = sum(weights.values())
    for path, w in weights.items():
        assert abs(drawn[path] / n - w / total) < 0.012


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    rows = ps.decode_documents(ps.encode_documents(docs)).collect()
    assert len(rows) == docs.count() and all(r["decoded"] == r["text"] for r in rows)
    again = {r["doc_id"]: r["piece_ids"] for r in ps.encode_documents(docs.repartition(3)).collect()}
    assert all(again[r["doc_id"]] == r["piece_ids"] for r in rows)
    other = {r["doc_id"]: r["piece_ids"] for r in ps.encode_documents(docs, seed=99).collect()}
    assert any(other[r["doc_id"]] != r["piece_ids"] for r in rows)


def test_odd_rows(clashing_docs, odd_rows, no_docs):
    coded = ps.encode_documents(clashing_docs)
    assert coded.columns == [*clashing_docs.columns, "piece_ids"]
    rows = ps.decode_documents(coded).collect()
    assert sorted(map(repr, ((r["doc_id"], r["decoded"]) for r in rows))) == sorted(map(repr, ((r[0], r[1]) for r in odd_rows)))
    assert all((r["piece_ids"] is None) == (r["text"] is None) for r in rows)
    twins = [r["piece_ids"] for r in rows if r["doc_id"] == 1]
    assert twins[0] == twins[1]
    assert ps.decode_documents(ps.encode_documents(no_docs)).count() == 0

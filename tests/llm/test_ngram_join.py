"""Components against all pairs of sets."""

import random

import numpy as np
import pytest

from stockroom.llm import ngram_join as nj
from stockroom.llm.components import components
from stockroom.session import lineage_scope, list_folder, scratch_path

SF0001 = "/root/testdata/sf0.001"
PASSAGE = " ".join(f"w{k}" for k in range(60))


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows):
    """[(id, text)] -> [(id, n, component)] by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if a and sets[j] and 100 * common >= 75 * (len(a) + len(sets[j]) - common):
                up[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted(((d, len(s), least.get(root(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=repr)


def found(frame):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in nj.similar_documents(frame).collect()), key=repr)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    assert found(docs) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_groups_of_near_copies_chains_and_borders(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(6):  # near copies with edits, and chains that drift apart
        words = [f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(4, 120))]
        for _ in range(40):
            rows.append(list(words))
            if rng.random() < 0.5:
                words = list(words)
            copy = rows[-1]
            for _ in range(rng.randrange(0, 3)):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(10**6)}"
    passage = [f"p{k}" for k in range(60)]  # shared by texts that are not alike
    rows += [passage + [f"u{rng.randrange(10**9)}" for _ in range(n)] for n in range(5, 45)]
    # 3 of 4 shingles common: exactly at the limit, and just below
    rows += [list("abcdefgh"), list("abcdefg"), list("abcdefgx"), list("abcdefghijk"), ["one"], ["one"], ["one", "two"]]
    rng.shuffle(rows)
    data = [(i, " ".join(r)) for i, r in enumerate(rows)]
    assert found(spark.createDataFrame(data, "doc_id long, text string")) == brute(data)


@pytest.mark.parametrize("n", [75, 100, 134])
def test_isolated_pairs_across_a_size_band(spark, n):
    """Sets of n - 1 and n shingles share lists of two only; another group
    has a pivot pair."""
    words = [f"w{k}" for k in range(n + 4)]
    other = [f"v{k}" for k in range(60)]
    texts = [words[:-1], words, other, [*other[:-1], "x"], [f"u{k}" for k in range(50)]]
    data = [(i, " ".join(t)) for i, t in enumerate(texts)]
    assert len({len(shingles(t)) for _, t in data[:2]} & {n - 1, n}) == 2
    got = found(spark.createDataFrame(data, "doc_id long, text string"))
    assert got == brute(data) and [c for _, _, c in got] == [0, 0, 2, 2, 4]


def test_shared_tokens_that_fall_together(spark):
    """The only two tokens shared by the prefixes of order 1 have equal upper
    32 bits (words found by search); the parts bring all shared tokens to one
    frequency class."""
    words = [f"q{k}" for k in (*range(506508, 506513), *range(556496, 556501))] + ["z0"]
    texts = [[*words, "one"], [*words, "two"], words[1:9], words[1:9], words[6:], words[6:]]
    data = [(i, " ".join(t)) for i, t in enumerate(texts)]
    got = found(spark.createDataFrame(data, "doc_id long, text string"))
    assert got == brute(data) and [c for _, _, c in got] == [0, 0, 2, 2, 4, 4]


def test_odd_rows(clashing_docs, odd_rows, no_docs):
    assert found(clashing_docs) == brute([(r[0], r[1]) for r in odd_rows])
    kept = nj.one_of_each(clashing_docs)
    assert kept.columns == clashing_docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(map(str, [1, 2, 3, 4, 5, 7, 8, None, None]))
    assert nj.similar_documents(no_docs).count() == 0 and nj.one_of_each(no_docs).count() == 0


def test_prefixes_of_linked_sets_share_enough():
    """The count test never loses a pair, under any order."""
    rng = np.random.default_rng(1)
    classes = rng.integers(0, 3, size=1 << 10).astype(np.uint8)
    for _ in range(300):
        n, m = rng.integers(1, 60), rng.integers(1, 60)
        common = rng.integers(0, min(n, m) + 1)
        pool = np.unique(rng.integers(0, 2**63, size=n + m, dtype=np.int64).astype(np.uint64))
        a, b = pool[:n], np.concatenate([pool[:common], pool[n : n + m - common]])
        if 100 * common < 75 * (len(a) + len(b) - common):
            continue
        overlap = -(-75 * (len(a) + len(b)) // 175)
        least = 1 + overlap - -(-75 * max(len(a), len(b)) // 100)
        for order in range(nj.ORDERS):
            shared = set(nj.prefix(a, classes, order, 75)) & set(nj.prefix(b, classes, order, 75))
            assert len(shared) >= least >= 1


@pytest.mark.parametrize("links", [[], [(1, 2), (2, 1), (2, 2)], [(i, i + 1) for i in range(60)], [(i, 0) for i in range(1, 40)] + [(100, 101)]])
def test_components(spark, links):
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    up = {}

    def root(i):
        while up.setdefault(i, i) != i:
            i = up[i]
        return i

    for a, b in links:
        up[root(a)] = root(b)
    nodes = {x for a, b in links for x in (a, b) if a != b}
    assert set(got) == nodes
    for x in nodes:
        for y in nodes:
            assert (got[x] == got[y]) == (root(x) == root(y))


def test_lists_of_the_same_nodes_count_once(spark):
    """Ninety tokens that the same three nodes share are one list, so the
    join of the rest meets each of its pairs once; other lists stay."""
    rows = [(t, n, 100) for t in range(1, 91) for n in (7, 8, 9)] + [(100, n, 100) for n in (7, 8)] + [(101, n, 100) for n in (7, 8, 10)]
    found = nj._alike(spark.createDataFrame(rows, "token long, node long, n int")).collect()
    assert sorted((r["token"], r["node"], r["alike"]) for r in found) == [
        (1, 7, 90), (1, 8, 90), (1, 9, 90), (100, 7, 1), (100, 8, 1), (101, 7, 1), (101, 8, 1), (101, 10, 1)]
    assert len({(r["mark1"], r["mark2"]) for r in found}) == 3


def test_a_common_passage_leaves_no_room(spark):
    """Twelve nodes share eight long lists and nothing else; the pairs that a
    join of the lists makes must share three tokens from their list on."""
    rows = [(t, n, 20, n, 1) for t in range(1, 9) for n in range(12)]
    rows += [(100 + 3 * t + n % 3, n, 20, n, 1) for t in range(12) for n in range(t, 12)]
    frame = spark.createDataFrame(rows, "token long, node long, n int, label long, alike long")
    found = {(r["token"], r["node"]): r["room"] for r in nj._with_room(frame).collect()}
    lists = {}
    for t, n, *_ in rows:
        lists.setdefault(t, set()).add(n)
    open_lists = sorted((len(m), t) for t, m in lists.items() if len(m) > 2)
    for (token, node), room in found.items():
        after = [t for at, t in open_lists if (at, t) >= (len(lists[token]), token) and node in lists[t]]
        assert room == len(after)
    assert {t for t, _ in found} == {t for _, t in open_lists}
    for a in range(12):  # a pair has room for all that it shares in the first list where it meets
        for b in range(a):
            both = [(at, t) for at, t in open_lists if {a, b} <= lists[t]]
            assert min(found[both[0][1], a], found[both[0][1], b]) >= len(both)


def test_classes_of_a_sketch(spark):
    """The driver gets a class for each counter; the mean comes from the sizes."""
    low = np.zeros(nj.SLICE, dtype=np.uint8)
    low[5], low[6], low[7] = 1, 200, 255
    more = np.array([[7], [1000]], dtype=np.int32).tobytes()
    rows = spark.createDataFrame([(3, bytearray(low.tobytes()), bytearray(more)), (3, bytearray(low.tobytes()), bytearray(b""))], "slice int, counts binary, more binary")
    got = nj._sketch_classes(rows, 2 * 456 + 1000)
    at = 3 * nj.SLICE
    assert got.dtype == np.uint8 and len(got) == 1 << nj.SKETCH_BITS
    assert [int(got[at + k]) for k in (4, 5, 6, 7)] == [0, 1, 8, 10] and got.astype(int).sum() == 19


def test_tables_of_the_search_go(spark):
    """The result reads two written tables; no other stays."""
    texts = [f"{PASSAGE} {i} {i}" for i in range(6)] * 3
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    folder = scratch_path(spark, "lineage")
    before = set(list_folder(spark, folder))
    with lineage_scope(spark) as paths:
        frame = nj.similar_documents(docs)
        left = set(list_folder(spark, folder)) - before
        assert len(paths) == 2 and left == {p.rsplit("/", 1)[1] for p in paths}
        assert {r["component_id"] for r in frame.collect()} == {0}

"""Components against all pairs; stars against a search; signatures against their theory."""

import random
import re

import numpy as np
import pytest

from stockroom.llm import minhash, stars
from stockroom.session import lineage_scope, list_folder, scratch_path

SF0001 = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def shingles(text, size=4):
    words = WORD.findall((text or "").translate(UPPER))
    return {tuple(words)} if 0 < len(words) < size else {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def joined(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[root(a)] = root(b)
    groups = {}
    for n in nodes:
        groups.setdefault(root(n), []).append(n)
    return list(groups.values())


def brute(rows, percent=80):
    sets = [shingles(t) for _, t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j]
             and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    out = []
    for group in joined(range(len(rows)), links):
        ids = [rows[i][0] for i in group if rows[i][0] is not None]
        least = min(ids) if ids else None
        out += [(rows[i][0], len(sets[i]), least, rows[i][0] == least) for i in group]
    return sorted(out, key=repr)


def got(frame):
    return sorted((tuple(r) for r in minhash.near_duplicates(frame).collect()), key=repr)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    assert got(docs) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_copies_chains_and_limits(spark):
    draw = random.Random(5)
    rows = []
    for group in range(12):
        base = [f"g{group}w{draw.randrange(10**6)}" for _ in range(draw.choice([9, 24, 43, 103]))]
        for copy in range(10):  # edits at the ends: similarities on both sides of the limit, and chains
            cut = draw.randrange(0, len(base) // 4)
            rows.append((len(rows), " ".join(base[cut:] + [f"n{copy}x{i}" for i in range(draw.randrange(0, 4))])))
    rows += [(1000, "a b c d e f g h i"), (1001, "A B C D E F G H I"), (1002, "a b c d e f g h"), (1003, "a b c d e f g h z"), (1004, "a b"), (1005, "A  b")]
    assert got(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_hot_passage_links_nothing_by_itself(spark):
    """Documents that share a long passage but no more than that stay apart."""
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(d, passage + " " + " ".join(f"d{d}w{i}" for i in range(30))) for d in range(60)]
    rows += [(100 + d, rows[d][1] + " more") for d in range(0, 60, 2)]
    assert got(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_odd_rows(clashing_docs, odd_rows, no_docs):
    assert got(clashing_docs) == brute([(r[0], r[1]) for r in odd_rows])
    assert minhash.near_duplicates(no_docs).count() == 0


def test_likely_pairs_hold_the_limit(spark):
    """Two bits of each minimum never stop a pair at the limit."""
    draw = np.random.default_rng(8)
    family = minhash.hash_family(minhash.BANDS * minhash.ROWS)
    rows = []
    for share in (0.8, 0.9, 0.3):
        for _ in range(60):
            tokens = draw.integers(0, 2**63, 400).astype(np.uint64)
            both = int(len(tokens) * share)
            a, b = tokens[:both], tokens  # one inside the other
            bits = [[int(x[0]) for x in minhash.planes(minhash.signature(t, family)[None, :])] for t in (a, b)]
            rows.append((share, 400, 400, *bits[0], *bits[1]))
    names = "share double, n int, m int, " + ", ".join(f"{c}{k} long" for c in "pq" for k in range(4))
    kept = spark.createDataFrame(rows, names).filter(minhash._likely(80)).groupBy("share").count().collect()
    counts = {r["share"]: r["count"] for r in kept}
    assert counts[0.8] == counts[0.9] == 60 and counts.get(0.3, 0) <= 1


def test_signatures_estimate_similarity():
    draw = np.random.default_rng(3)
    family = minhash.hash_family(minhash.BANDS * minhash.ROWS)
    for share in (0.5, 0.8, 0.95):
        same = []
        for _ in range(60):
            tokens = draw.integers(0, 2**63, 1000).astype(np.uint64)
            common = int(1000 * share)
            a, b = tokens[:common], np.concatenate([tokens[:common], tokens[common:]])
            same.append((minhash.signature(a, family) == minhash.signature(b, family)).mean())
        assert np.mean(same) == pytest.approx(share, abs=0.02)


@pytest.mark.parametrize("kind", ["path", "star", "random", "none"])
def test_stars(spark, kind):
    draw = random.Random(9)
    names = draw.sample(range(-(10**6), 10**6), 70)
    pairs = {"path": [(names[i], names[i + 1]) for i in range(69)], "star": [(names[0], n) for n in names] + [(names[3], names[0])],
             "random": [(draw.choice(names), draw.choice(names)) for _ in range(50)], "none": []}[kind]
    found = {r["node"]: r["label"] for r in stars.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    nodes = {n for a, b in pairs if a != b for n in (a, b)}
    assert found == {n: min(g) for g in joined(nodes, [(a, b) for a, b in pairs if a != b]) for n in g}


def test_buckets_of_copies_of_one_node_are_not_shared(spark):
    """Rows of one node meet in all buckets and count once."""
    family = minhash.hash_family(minhash.BANDS * minhash.ROWS)
    draw = np.random.default_rng(4)
    tokens = draw.integers(0, 2**63, 100).astype(np.uint64)
    sets = {1: tokens, 2: np.append(tokens, np.uint64(7)), 3: draw.integers(0, 2**63, 100).astype(np.uint64)}
    rows = [(node, len(sets[node]), bytearray(minhash.signature(sets[node], family).tobytes())) for node in (1, 2, 3, 3, 1, 3)]
    frame = spark.createDataFrame(rows, "node long, n int, minima binary").repartition(3)
    found = [(r["bucket"], r["node"]) for r in minhash.shared_bands(frame).collect()]
    assert len(found) == len(set(found)) > 20 and {n for _, n in found} == {1, 2}


def test_tables_of_the_search_go(spark):
    """Repeated rows, and near copies; the result reads two written tables and
    no other stays."""
    base = " ".join(f"w{k}" for k in range(60))
    rows = [(i % 6, f"{base} {i % 6}") for i in range(18)] + [(50, None)]
    folder = scratch_path(spark, "lineage")
    before = set(list_folder(spark, folder))
    with lineage_scope(spark) as paths:
        frame = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
        left = set(list_folder(spark, folder)) - before
        assert len(paths) == 2 and left == {p.rsplit("/", 1)[1] for p in paths}
        assert sorted((tuple(r) for r in frame.collect()), key=repr) == brute(rows)


def test_near_copies_about_the_limit_make_no_rows_for_each_pair(spark, monkeypatch):
    """Each two copies are just short of the limit, unless they share two edited
    places: no table of the search holds more than a row for each node and band."""
    draw = random.Random(21)
    rows = []
    for doc_id in draw.sample(range(10**6), 200):
        words = [f"w{k}" for k in range(250)]
        for place in draw.sample(range(5, 245, 4), 4):
            words[place] = f"d{doc_id}p{place}"
        rows.append((doc_id, " ".join(words)))
    most, write = [], minhash.cut_lineage

    def counted(frame, *args, **kwargs):
        written = write(frame, *args, **kwargs)
        most.append(written.count())
        return written

    monkeypatch.setattr(minhash, "cut_lineage", counted)
    assert got(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)
    assert max(most) <= minhash.BANDS * len(rows)

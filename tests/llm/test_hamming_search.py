"""Neighbours against brute force."""

from pathlib import Path

import numpy as np
import pyarrow.parquet as pq
import pytest

from stockroom import session
from stockroom.llm import hamming_search as hs

SF001 = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>"


def brute(ids, x, k):
    out = {}
    for i in np.flatnonzero(ids % 20 == 0):
        s = (x * x[i]).sum(axis=1)
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != ids[i]][:k]
        out[int(ids[i])] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def found_lists(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def recall(found, truth):
    return sum(len({v for v, _ in found.get(q, [])} & {v for v, _ in t}) for q, t in truth.items()) / sum(map(len, truth.values()))


def test_recall_on_whole_table(spark):
    rows = spark.read.parquet(f"{SF001}/embeddings.parquet").select("vec_id", "embedding")
    data = rows.orderBy("vec_id").collect()
    ids, x = np.array([r[0] for r in data]), np.array([r[1] for r in data], dtype=float)
    found = found_lists(hs.search(rows, rows.filter("vec_id % 20 = 0")).collect())
    truth = brute(ids, x, 20)
    assert recall(found, truth) >= 0.9
    scores = {q: dict(t) for q, t in brute(ids, x, len(ids)).items()}
    for q, hits in found.items():
        assert len(hits) == len({v for v, _ in hits}) <= 20
        assert all(abs(scores[q][v] - s) < 1e-12 for v, s in hits)
        assert hits == sorted(hits, key=lambda h: (-h[1], h[0]))


def test_every_code_within_the_radius_is_found():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(600, 16))
    coder = hs.learn(x, float((x * x).sum(axis=1).max()), 5)
    codes = coder.substrings(x)
    apart = sum(hs.distances(codes[:, j], codes[:, j]).astype(int) for j in range(hs.SUBSTRINGS))
    for radius in (0, 3, 9, 14, 21):
        assert (hs.Block(codes).within(codes, radius) == (apart <= radius)).all()


def test_isolated_vectors_get_all_their_rows(spark):
    """Tight clusters set a small radius; the vectors far from all others are queries too."""
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(20, 32))
    x = centres[rng.integers(0, 20, size=2000)] + 1e-3 * rng.normal(size=(2000, 32))
    far = [0, 400, 800, 1200]
    x[far] = rng.normal(size=(4, 32))
    x /= np.linalg.norm(x, axis=1)[:, None]
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = found_lists(hs.search(frame, frame.filter("vec_id % 20 = 0")).collect())
    assert {q: len(hits) for q, hits in found.items()} == dict.fromkeys(range(0, 2000, 20), 20)


def test_copies_ties_and_lengths(spark):
    rng = np.random.default_rng(6)
    hot = rng.normal(size=8)
    rows = [(i, [float(v) for v in (hot if i % 3 == 0 else rng.normal(size=8) * (1 + i % 5))]) for i in range(600)]
    frame = spark.createDataFrame(rows, SCHEMA)
    x = np.array([np.asarray(v, dtype=np.float32) for _, v in rows], dtype=float)
    truth = brute(np.arange(600), x, 20)
    found = found_lists(hs.search(frame, frame.filter("vec_id % 20 = 0"), recall=1.0).collect())
    assert recall(found, truth) >= 0.95
    # the copies of a hot query: the smallest other ids, its own left out
    hot_query = found[60]
    same = [v for v, s in hot_query if s == truth[60][0][1]]
    assert same == sorted(same)


@pytest.mark.parametrize("bad", [None, [0.0] * 4, [1.0, None, 2.0, 3.0], [float("nan")] * 4, [float("inf"), 0.0, 0.0, 1.0], [1.0, 2.0], []])
def test_unusable_vectors_take_no_part(spark, bad):
    good = [(i, [float(i), 1.0, 2.0, -1.0]) for i in range(1, 30)]
    frame = spark.createDataFrame([*good, (40, bad), (0, bad), (None, [1.0, 1.0, 1.0, 1.0]), good[4]], SCHEMA)
    found = found_lists(hs.search(frame, frame.filter("vec_id % 20 = 0")).collect())
    assert set(found) == {20}
    assert len(found[20]) == 20 and not {0, 20, 40} & {v for v, _ in found[20]}


def test_few_and_no_rows(spark):
    frame = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5])], SCHEMA)
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in hs.search(frame, frame.filter("vec_id = 0")).collect()] == [(0, 1, 1)]
    none = frame.filter("false")
    assert hs.search(none, none).count() == 0
    assert hs.search(frame, none).count() == 0


def shuffle_bytes(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return sum(Path(f).stat().st_size for f in files.split("\n") if f and Path(f).exists())


def test_disk_stays_near_the_input(spark, tmp_path, monkeypatch):
    """Vectors are not written again for each block of queries, nor found rows for each block of vectors."""
    rng = np.random.default_rng(12)
    x = rng.normal(size=(20_000, 64)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1)[:, None]
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], SCHEMA)
    frame.write.parquet(str(tmp_path / "x"))
    rows, tables = spark.read.parquet(str(tmp_path / "x")), []

    def kept(df, name="stage", *args, **more):
        out = session.cut_lineage(df, name, *args, **more)
        tables.append(out)
        return out

    monkeypatch.setattr(hs, "cut_lineage", kept)
    before = shuffle_bytes(spark)
    assert hs.search(rows, rows.filter("vec_id % 20 = 0")).count() == 20_000
    tables = sum(Path(f.removeprefix("file:")).stat().st_size for t in tables for f in t.inputFiles())
    assert shuffle_bytes(spark) - before + tables < 4 * x.nbytes


def test_probes_and_products_find_the_same():
    rng = np.random.default_rng(14)
    centres = rng.normal(size=(30, 24))
    x = centres[rng.integers(0, 30, size=5000)] + 0.05 * rng.normal(size=(5000, 24))
    x[::7] *= 2
    coder = hs.learn(x[:2000], float((x * x).sum(axis=1).max()), 5)
    queries, ids = x[::25] + 0.01 * rng.normal(size=(200, 24)), rng.permutation(5000)
    codes, asked = coder.substrings(x), coder.substrings(queries, query=True)
    apart = sum(hs.distances(asked[:, j], codes[:, j]).astype(int) for j in range(hs.SUBSTRINGS))
    exact = (queries[:, None, :] * x[None]).sum(axis=2)
    for radius in (2, 7, 12, 30, 64):
        if radius < 20:
            assert set(zip(*hs.Block(codes).probe(asked, radius), strict=True)) == set(zip(*np.nonzero(apart <= radius), strict=True))
        found = []
        for pays in (1e-9, 1e9):
            hs_pays, hs.PAYS = hs.PAYS, pays
            try:
                group = hs.Group([q.tobytes() for q in queries], 8, coder, radius, 5)
                for at in range(0, 5000, 700):
                    group.add(x[at : at + 700], ids[at : at + 700], np.ones(len(x[at : at + 700]), dtype=np.int32))
                found.append(group.found().to_pylist())
            finally:
                hs.PAYS = hs_pays
        assert found[0] == found[1]
        for q, row in enumerate(found[0]):
            inside = np.flatnonzero(apart[q] <= radius)
            order = inside[np.lexsort((ids[inside], -exact[q][inside]))][:6]
            assert [e["ids"] for e in row["best"]] == [[i] for i in ids[order].tolist()]
            assert np.allclose([-e["s"] for e in row["best"]], exact[q][order], rtol=1e-12)


def test_equal_vectors_of_either_precision_are_one(spark):
    rows = [(i, [float(np.float32(v)) for v in (0.1 * (i // 3 + 1), -0.3, 1.0, 0.5)]) for i in range(90)]
    rows += [(100 + i, [0.1 * (i + 1), -0.3, 1.0, 0.5]) for i in range(5)]
    wide = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    narrow = spark.createDataFrame(rows[:90], SCHEMA)
    assert hs.usable(wide, "vec_id", "embedding", 3).count() == 35
    assert sorted(hs.usable(narrow, "vec_id", "embedding", 3).collect()) == sorted(hs.usable(wide.filter("vec_id < 100"), "vec_id", "embedding", 3).collect())
    data = np.array([v for _, v in rows])
    found = found_lists(hs.search(wide, wide.filter("vec_id % 20 = 0"), k=4, recall=1.0).collect())
    assert recall(found, brute(np.array([i for i, _ in rows]), data, 4)) >= 0.95
    assert found_lists(hs.search(wide.filter("vec_id < 100"), narrow.filter("vec_id % 20 = 0"), k=4).collect()) == found_lists(
        hs.search(narrow, narrow.filter("vec_id % 20 = 0"), k=4).collect())


def test_pieces_come_in_small_row_groups(spark):
    big = spark.range(0, 100, 1, 1).selectExpr("cast(repeat(uuid(), 14000) as binary) AS vecs")
    files = session.cut_lineage(big, "vectors", options=hs.PIECES_TABLE).inputFiles()
    groups = [g for f in files for m in [pq.ParquetFile(f.removeprefix("file:")).metadata] for g in map(m.row_group, range(m.num_row_groups))]
    assert max(g.num_rows for g in groups) <= 16

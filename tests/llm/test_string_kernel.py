"""Held-out accuracy, the Nyström weights against plain kernel ridge regression."""

import zlib

import numpy as np

from stockroom.llm import string_kernel as sk

SF001 = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    model = sk.fit(docs)
    rows = sk.predict(docs.select("doc_id", "lang", sk.held_out("doc_id").alias("held_out"), "text"), model).collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in held} == {r["doc_id"] for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2}
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 and r["lang_pred"] in model.languages for r in rows)


def test_kernel_is_common_over_geometric_mean():
    a, b = "the quick fox", "the slow fox"
    pa, pb = set(sk.present(a)), set(sk.present(b))
    rows = sk.presence_rows([a, b])
    assert abs(rows[0] @ rows[1] - len(pa & pb) / np.sqrt(len(pa) * len(pb))) < 1e-6


def test_equals_kernel_ridge_regression(spark):
    """With every training text a landmark the Nyström solution is exact."""
    texts = [("en", f"the {w} of the house and the {w}") for w in ("cat", "dog", "river", "tower", "street")]
    texts += [("de", f"der {w} und das {w} ist nicht hier") for w in ("hund", "baum", "turm", "weg", "fluss")]
    frame = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(texts * 3)], "doc_id long, text string, lang string")
    train = [t for t in frame.collect() if zlib.crc32(str(t["doc_id"]).encode()) % 4 != 2]
    model = sk.fit(frame, per_language=100)
    asked = ["the bird and the tree", "das haus und der vogel"]
    x = sk.presence_rows([t["text"] for t in train]).astype(float)
    y = np.array([[1.0 if t["lang"] == name else -1.0 for name in model.languages] for t in train])
    # ridge with a nearly free bias: solve in the features of the kernel
    phi, ridge = np.hstack([x, np.ones((len(x), 1))]), sk.RIDGE * len(x)
    scale = np.append(np.full(x.shape[1], 1 / ridge), 1 / (ridge * 1e-6))
    dual = np.linalg.solve((phi * scale) @ phi.T + np.eye(len(x)), y)
    q = np.hstack([sk.presence_rows(asked).astype(float), np.ones((2, 1))])
    assert np.allclose(model.scores(asked), (q * scale) @ phi.T @ dual, atol=2e-3)


def test_odd_rows(spark, clashing_docs, odd_rows, no_docs):
    model = sk.fit(clashing_docs)
    rows = sk.predict(clashing_docs.select("doc_id", "text", "score"), model).select("doc_id", "lang_pred").collect()
    assert len(rows) == len(odd_rows)
    by_id = {r["doc_id"]: r["lang_pred"] for r in rows}
    assert by_id[2] == by_id[3] == by_id[4] == "und" and by_id[1] == "en"
    assert sk.fit(no_docs) is None
    assert {r["lang_pred"] for r in sk.predict(clashing_docs.select("doc_id", "text"), None).collect()} == {"und"}
    assert sk.predict(no_docs.select("doc_id", "text"), model).count() == 0


def test_rare_languages_survive_the_bound(spark):
    texts = [("en", f"the house of the {k} and the river") for k in range(900)] + [("de", f"der hund und das {k} haus") for k in range(9)]
    frame = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(texts)], "doc_id long, text string, lang string")
    whole = {r["lang"]: r["count"] for r in sk.training_sample(frame).groupBy("lang").count().collect()}
    counts = {r["lang"]: r["count"] for r in sk.training_sample(frame, most=60, least=100).groupBy("lang").count().collect()}
    assert counts["de"] == whole["de"] and 60 <= counts["en"] <= 150 < whole["en"]
    assert sk.fit(frame, most=60).languages == ["de", "en"]


def test_numbers_are_no_letters():
    assert not any(map(sk.has_letter, ("², ½ Ⅷ 12 _", "", None))) and sk.has_letter("1 ñ") and sk.has_letter("梦")

"""Counts against a loop over the text, line limits against counters."""

import random
import re
from collections import Counter

from stockroom.llm import quality_rules as qr

SF001 = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    inside = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside)


def columns(r):
    return r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = qr.judge(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert columns(r) == counts(texts[r["doc_id"]])
        failed = r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"])
    # a boilerplate line stands in a tenth of each host's texts
    assert sum(r["removed_chars"] > 0 for r in rows) > 50 and any(not r["base_failed"] and not r["kept"] for r in rows)
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF001}/labels.parquet").collect()}
    clean = [r["kept"] for r in rows if labels.get(r["doc_id"]) == 1 and not r["base_failed"]]
    assert sum(clean) / len(clean) > 0.99


def test_repeated_windows_overlap(spark):
    rng = random.Random(5)
    texts = ["a b c d e f g h a b c d e f g h", "a a a a a a a a a", "a b c d e f g h", "x\nx\n\n x\ny"]
    texts += [" ".join(rng.choice("abc") for _ in range(n)) for n in (0, 7, 8, 9, 40, 300)]
    rows = qr.judge(spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, source string")).collect()
    assert {r["doc_id"]: columns(r) for r in rows} == {i: counts(t) for i, t in enumerate(texts)}


def test_frequent_lines(spark):
    own = [" ".join(f"w{chr(97 + i)}{chr(97 + k)}" for k in range(25)) for i in range(12)]
    footer = "Subscribe to our  newsletter 2024 today and never miss a single post again"
    data = [(i, f"{own[i]}\n{footer.upper() if i % 2 else footer}", "h") for i in range(10)]
    data += [(10, f"{footer}\n" * 30 + own[10], "h"), (11, f"{own[11]}\n{footer}", "other")]
    data += [(20 + i, f"{own[0]} again", "h") for i in range(30)]  # copies count once
    docs = spark.createDataFrame(data, "doc_id long, text string, source string").selectExpr("*", "cast(length(text) as long) as n_chars")
    limits = {"line_docs": 5, "line_share": 0.0}
    rows = {r["doc_id"]: r for r in qr.judge(docs, **limits).collect()}
    assert all(rows[i]["kept"] and rows[i]["removed_chars"] == len(footer) for i in range(10))
    assert rows[10]["removed_chars"] == 30 * len(footer) and not rows[10]["kept"]  # depleted
    assert rows[11]["removed_chars"] == 0 and rows[20]["removed_chars"] == 0
    cleaned = {r["doc_id"]: r for r in qr.cleaned_documents(docs, **limits).collect()}
    assert cleaned[0]["text"] == own[0] and cleaned[0]["n_chars"] == len(own[0])
    assert cleaned[11]["text"] == f"{own[11]}\n{footer}"
    assert set(cleaned) == {d for d, r in rows.items() if r["kept"]}


def test_limits_act_alike_at_every_size(spark):
    """One line in all texts of a small host, in a tenth and in a fiftieth of
    larger ones: production limits."""
    line = "Read the terms of use before you go on from here"

    def own(host, i):
        letters = str(i).translate(str.maketrans("0123456789", "abcdefghij"))  # digits do not count in a line
        return " ".join(f"{host}{letters}{chr(97 + k % 26)}{k // 26}" for k in range(30))

    data = []
    for host, n, every in (("tiny", 8, 1), ("few", 4, 1), ("mid", 100, 10), ("big", 1000, 10), ("rare", 100, 50), ("rarer", 1000, 50)):
        data += [(own(host, i), host, i % every == 0) for i in range(n)]
    rows = [(i, f"{text}\n{line}" if with_line else text, host) for i, (text, host, with_line) in enumerate(data)]
    rows.append((len(rows), f"nothing much of its own\n{line} {line} {line}\n{line}", "tiny"))  # too few words of its own
    rows.append((len(rows), " ".join(chr(97 + k) * 2 for k in range(24)) + "\n" + f"{line}\n" * 2, "tiny"))  # too small a share of its own
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: r for r in qr.judge(docs).collect()}
    removed = {host: sum(got[i]["removed_chars"] > 0 for i, r in enumerate(rows) if r[2] == host) for host in {r[2] for r in rows}}
    assert removed == {"tiny": 10, "few": 0, "mid": 10, "big": 100, "rare": 0, "rarer": 0}
    assert [got[len(rows) - k]["kept"] for k in (1, 2)] == [False, False]
    assert all(got[i]["kept"] for i in range(len(rows) - 2))


def test_row_keys_tell_nulls_apart(spark):
    rows = [(None, "5", "t"), (5, None, "t"), (5, "5", None), (None, None, "t"), (5, "t", None), (None, "t", None), (None, None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    assert docs.select(qr.row_key("doc_id", "source", "text")).distinct().count() == len(rows)


def test_odd_rows(clashing_docs, odd_rows, no_docs):
    rows = qr.judge(clashing_docs).collect()
    assert sorted(map(columns, rows)) == sorted(counts(r[1]) for r in odd_rows)
    out = qr.cleaned_documents(clashing_docs)
    assert out.columns == clashing_docs.columns
    assert sorted(r["doc_id"] for r in out.collect()) == [1, 1, 5, 6]
    assert qr.judge(no_docs).count() == 0 and qr.cleaned_documents(no_docs).count() == 0


def test_no_python_in_the_plans(clashing_docs):
    for frame in (qr.judge(clashing_docs), qr.cleaned_documents(clashing_docs)):
        assert "Python" not in frame._jdf.queryExecution().toString()

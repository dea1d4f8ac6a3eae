"""Collocations against counts of all phrases."""

import re

import numpy as np
import pytest

from stockroom.llm import bitmaps, collocations

SF0001 = "/root/testdata/sf0.001"
UPPER = {c: c + 32 for c in range(65, 91)}


def brute(rows, k=2000, least=10, covered=50):
    counts, totals = {}, {}
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] = totals.get(lang, 0) + len(words)
            for size in (1, 2, 3):
                for i in range(len(words) - size + 1):
                    key = (lang, *words[i : i + size])
                    counts[key] = counts.get(key, 0) + 1
    found = {}
    for (lang, *words), a in counts.items():
        if len(words) < 2 or a < least:
            continue
        if len(words) == 2 and any(100 * f >= covered * a for (o, *x), f in counts.items()
                                   if len(x) == 3 and o == lang and f >= least and (x[:2] == words or x[1:] == words)):
            continue
        cuts = []
        for c in range(1, len(words)):
            left, right = counts[(lang, *words[:c])], counts[(lang, *words[c:])]
            cuts.append((10**6 * a * a // (left * right), c, left, right))
        score, _, left, right = min(cuts)
        found.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    return sorted((lang, rank, p.decode(), -a, left, right, totals[lang], -s) for lang, its in found.items()
                  for rank, (s, a, p, left, right) in enumerate(sorted(its)[:k], 1))


def got(frame, **how):
    return sorted(tuple(r) for r in collocations.collocations(frame, **how).collect())


@pytest.mark.parametrize("how", [{}, {"budget": 50}, {"least": 3, "budget": 2000, "k": 40}])
def test_whole_table(spark, how):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    rows = [(r["lang"], r["text"]) for r in docs.collect()]
    truth = brute(rows, **{x: v for x, v in how.items() if x != "budget"})
    assert truth and got(docs, **how) == truth


def test_names_of_languages_as_words(spark):
    """A word spelled like a language is counted in its own language only."""
    rows = [("en", "en de x en de. es en")] * 7 + [("es", "es de x es de; en es")] * 9 + [("de", "de en de en de en")] * 5
    assert got(spark.createDataFrame(rows, "lang string, text string")) == brute(rows)


def test_overlaps_pieces_and_ties(spark):
    rows = [("x", "a a a a a a"), ("x", "b c, b c. b c\nb\x0bc b\tc! b c"), ("x", "d e d e d e"), (None, "A b a B a b"), ("und", "a b"), ("x", "ü ß ü ß"), ("x", None)] * 6
    for least in (1, 5, 20):
        assert got(spark.createDataFrame(rows, "lang string, text string"), least=least) == brute(rows, least=least)


def test_odd_rows(clashing_docs, odd_rows, no_docs):
    assert got(clashing_docs, least=2) == brute([(r[2], r[1]) for r in odd_rows], least=2)
    assert got(no_docs) == []


def test_groups_keep_to_the_budget():
    sizes = np.array([3, 4, 0, 25, 2, 9, 1, 10, 11])
    groups = collocations.Groups(sizes, 10)
    held = {}
    for k, n in enumerate(sizes):
        for g in range(groups.first[k], groups.first[k] + groups.count[k]):
            held.setdefault(g, []).append(n / groups.count[k])
    assert all(sum(v) <= 10 for v in held.values()) and sorted(held) == list(range(max(held) + 1))


def test_bitmap(spark):
    draw = np.random.default_rng(1)
    inside, outside = (draw.integers(0, 2**64, 500, dtype=np.uint64) for _ in range(2))
    frame = spark.createDataFrame([(int(x),) for x in inside.view(np.int64)], "h long")
    for bits in (24, 26):
        packed = bitmaps.bitmap(frame, frame["h"], bits)
        assert bitmaps.holds(packed, inside).all() and bitmaps.holds(packed, outside).sum() < 5

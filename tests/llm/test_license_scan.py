"""Phrases against a word-by-word search, notices against a whole-text search."""

import random
import re
import time

import regex

from stockroom.llm import license_scan as ls

SF0001 = "/root/testdata/sf0.001"

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def slow_places(text):
    words = words_of(text)
    return [(i, label) for phrase, label in ls.PHRASES.items() for p in [phrase.split()]
            for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]


def slow_labels(text):
    low = " " + " ".join(words_of(text)) + " "
    return {label for notice, label, k in ls.NOTICES
            if regex.search(rf"(?<= )(?:{regex.escape(notice, special_only=False, literal_spaces=True)}){{e<={k}}}(?= )", low)}


def check(rows):
    for text, r in rows:
        places = slow_places(text)
        starts = [i for i, _ in places]
        assert (r["n_words"], r["n_base"]) == (len(words_of(text)), len(places))
        assert (r["first_word"], r["last_word"]) == (min(starts, default=None), max(starts, default=None))
        assert r["base_labels"] == ",".join(sorted({x for _, x in places}))
        assert r["labels"] == ",".join(sorted({x for _, x in places} | slow_labels(text)))
        assert 0 <= r["score"] <= 1
        for s in r["spans"]:
            found = words_of(text)[s["word"] : s["word"] + s["words"]]
            assert words_of(text[s["char_start"] : s["char_end"]]) == found
            assert s["edits"] <= next(k for n, _, k in ls.NOTICES if n == s["notice"])


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    found = ls.scan_documents(docs).collect()
    assert len(found) == len(texts)
    check((texts[r["doc_id"]], r) for r in found)
    assert any(r["spans"] for r in found)


def test_edited_notices():
    scanner = ls.Scanner()
    for text in ["Released undr the MIT Licence.", "Apache License, Verson 2", "underr the m1t license", "GNU Generl Public Licence v3",
                 "mit license", "CC BY-NC cc by nc", "all rights reservd", "the under mit license", "permission is hereby granted, free of charge to any persn obtaining a copy"]:
        r = scanner.scan(text)
        assert set(filter(None, r["labels"].split(","))) == {x for _, x in slow_places(text)} | slow_labels(text), text
    assert scanner.scan("Released undr the MIT Licence.")["labels"] == "mit"
    assert scanner.scan("CC BY-NC cc by nc")["n_base"] == 2


def test_odd_rows(clashing_docs, odd_rows, no_docs):
    found = ls.scan_documents(clashing_docs).collect()
    assert len(found) == len(odd_rows)
    assert sorted(r["n_words"] for r in found) == sorted(len(words_of(t)) for _, t, *_ in odd_rows)
    assert ls.scan_documents(no_docs).count() == 0


def spans_of(text, scanner):
    return sorted((s[1], s[2], s[3], s[6]) for s in scanner.scan(text)["spans"])


def slow_spans(text):
    """Every notice searched over the whole text, without windows."""
    low, out = " " + " ".join(words_of(text)) + " ", []
    for notice, _, k in ls.NOTICES:
        for m in regex.finditer(rf"(?<= )(?:{regex.escape(notice, special_only=False, literal_spaces=True)}){{e<={k}}}(?= )", low, regex.ENHANCEMATCH):
            first = low[: m.start()].count(" ") - 1
            out.append((notice, first, len(m.group().split(" ")), sum(m.fuzzy_counts)))
    return sorted(out)


def test_spans_against_a_search_of_the_whole_text():
    draw, scanner = random.Random(6), ls.Scanner()
    for _ in range(60):
        parts = []
        for _ in range(draw.randrange(1, 9)):
            notice = list(draw.choice(ls.NOTICES)[0])
            for _ in range(draw.randrange(0, 4)):
                at = draw.randrange(1, len(notice) - 1)
                notice[at : at + draw.randrange(0, 2)] = draw.choice(["", "x", notice[at]])
            parts += ["".join(notice), *(["filler words"] * draw.randrange(0, 2))]
        text = " ".join(parts)
        assert spans_of(text, scanner) == slow_spans(text)


def test_an_edited_notice_before_a_better_one_is_found():
    scanner = ls.Scanner([("all rights reserved", "reserved", 2)], {})
    assert [(s[2], s[6]) for s in scanner.scan("all rihts reserved all rights reserved")["spans"]] == [(0, 1), (3, 0)]


def test_very_many_notices_take_linear_time():
    scanner = ls.Scanner([("all rights reserved", "reserved", 2)], {"all rights": "x"})

    def seconds(n):
        began = time.process_time()
        found = scanner.scan("all rights reserved and all rihts reserved more " * n)
        assert len(found["spans"]) == 2 * n and found["n_base"] == n
        return time.process_time() - began

    seconds(100)
    assert seconds(16_000) < 12 * max(seconds(4_000), 0.05)

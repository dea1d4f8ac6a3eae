"""License scan: notices and their fuzzy variants, with spans.

A text is reduced to its words (A-Z lowered, joined by one space). Exact
phrases are counted where their words stand consecutively. Each notice of
the table below may also occur with edits: a notice allowed ``k`` character
edits is cut into ``k + 1`` pieces, and by the pigeonhole principle at least
one piece stands unchanged in every occurrence. One Aho-Corasick pass finds
all pieces; around each hit the regex library's bounded-error search decides
whether the notice occurs with at most ``k`` edits, starting and ending at
word boundaries, and gives its span and edit count.

Defined results
    null text has no words; empty and very long texts are scanned whole;
    repeated rows and null ids give a row each; overlapping matches of a
    notice go to the one that begins first, improved where it stands, so that
    notices that follow each other are all found; columns other than id and
    text are not read; an empty table gives an empty result. The time grows
    with the length of a text, also where it holds very many notices.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The exact phrases and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Notices searched with edits: words, label, largest number of edits.
NOTICES = [
    ("under the mit license", "mit", 2),
    ("apache license version 2", "apache-2", 2),
    ("licensed under cc by nc", "cc-by-nc", 2),
    ("creative commons attribution noncommercial", "cc-by-nc", 3),
    ("licensed under cc by sa", "cc-by-sa", 1),
    ("creative commons attribution sharealike", "cc-by-sa", 3),
    ("gnu general public license", "gpl", 2),
    ("gnu lesser general public license", "lgpl", 2),
    ("mozilla public license", "mpl", 2),
    ("bsd 3 clause license", "bsd-3-clause", 1),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit", 4),
    ("all rights reserved", "all-rights-reserved", 2),
]
NOT_WORD = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER_TO_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
SPAN_TYPE = "struct<label:string,notice:string,word:bigint,words:bigint,char_start:bigint,char_end:bigint,edits:int>"


@dataclass(frozen=True)
class Hit:
    """A match in the reduced text: half-open span and number of edits."""

    notice: int
    start: int
    end: int
    edits: int


def lowered(text: str) -> str:
    """A-Z to a-z, all else as it is."""
    return text.lower() if text.isascii() else text.translate(UPPER_TO_LOWER)


def reduced(text: str | None) -> str:
    """The words joined by single spaces, with a space at both ends."""
    words = NOT_WORD.sub(" ", lowered(text or "")).strip(" ")
    return f" {words} " if words else " "


def split_evenly(notice: str, pieces: int) -> list[str]:
    cuts = [round(len(notice) * k / pieces) for k in range(pieces + 1)]
    return [notice[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


class Scanner:
    """Piece automaton and one bounded-error pattern per notice."""

    def __init__(self, notices=NOTICES, phrases=PHRASES) -> None:
        import ahocorasick  # needed by this operator alone
        import regex

        self.notices = notices
        self.phrases = phrases
        self.automaton = ahocorasick.Automaton()
        owners: dict[str, list[tuple[int, int]]] = {}
        for number, (words, _, edits) in enumerate(notices):
            at = 0
            for piece in split_evenly(words, edits + 1):
                owners.setdefault(piece, []).append((number, at))
                at += len(piece)
        for piece, held in owners.items():
            self.automaton.add_word(piece, (len(piece), held))
        self.automaton.make_automaton()
        self.patterns = [
            regex.compile(rf"(?<= )(?:{regex.escape(words, special_only=False, literal_spaces=True)}){{e<={edits}}}(?= )", regex.ENHANCEMATCH)
            for words, _, edits in notices
        ]

    def windows(self, text: str) -> dict[int, list[list[int]]]:
        """Notice -> merged windows of the text in which it may occur."""
        found: dict[int, list[list[int]]] = {}
        for last, (size, held) in self.automaton.iter(text):
            for number, offset in held:
                words, _, edits = self.notices[number]
                start = max(0, last - size - offset - edits)
                end = last - size + 1 - offset + len(words) + edits + 1
                spans = found.setdefault(number, [])
                if spans and start <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], end)
                else:
                    spans.append([start, end])
        return found

    def fuzzy(self, text: str) -> list[Hit]:
        hits = []
        for number, spans in self.windows(text).items():
            for start, end in spans:
                for m in self.patterns[number].finditer(text, start, min(end, len(text))):
                    hits.append(Hit(number, m.start(), m.end(), sum(m.fuzzy_counts)))
        return hits

    def exact(self, text: str) -> list[tuple[int, str]]:
        """(position, label) of every place of every phrase."""
        places = []
        for words, label in self.phrases.items():
            at = text.find(f" {words} ")
            while at >= 0:
                places.append((at, label))
                at = text.find(f" {words} ", at + 1)
        return places

    def scan(self, text: str | None) -> dict:
        low = reduced(text)
        n_words = low.count(" ") - 1 if len(low) > 1 else 0
        found, hits = self.exact(low), self.fuzzy(low)
        # the word at a place is the number of spaces before it, looked up
        blanks = np.flatnonzero(np.frombuffer(low.encode("utf-32-le"), dtype=np.uint32) == 32) if found or hits else None
        places = [(int(np.searchsorted(blanks, at)), label) for at, label in found]
        score = max([1.0] * bool(places) + [1 - h.edits / len(self.notices[h.notice][0]) for h in hits], default=0.0)
        base = {label for _, label in places}
        spans = []
        if hits:
            words = [m.span() for m in WORD.finditer(lowered(text))]
            for h in sorted(hits, key=lambda h: (h.start, h.end, h.notice)):
                first, behind = (int(x) for x in np.searchsorted(blanks, (h.start, h.end)))
                first, many = first - 1, behind - first + 1
                spans.append((self.notices[h.notice][1], self.notices[h.notice][0], first, many,
                              words[first][0], words[first + many - 1][1], h.edits))
        return {
            "n_words": n_words, "n_base": len(places),
            "first_word": min((w for w, _ in places), default=None), "last_word": max((w for w, _ in places), default=None),
            "base_labels": ",".join(sorted(base)), "labels": ",".join(sorted(base | {s[0] for s in spans})),
            "score": score, "spans": spans,
        }


def scan_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", notices=NOTICES, phrases=PHRASES) -> DataFrame:
    """One row per document: id, n_words, the exact phrase places, labels,
    score (best similarity) and spans: label, notice, first word and number
    of words, character span in the original text, edits."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(notices, phrases)
        for batch in batches:
            out = pd.DataFrame([scanner.scan(t) for t in batch["text"]], index=batch.index, columns=[
                "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"])
            out.insert(0, "id", batch["id"].astype("Int64"))
            yield out.astype({"first_word": "Int64", "last_word": "Int64"})

    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    schema = ("id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
              f"score double, spans array<{SPAN_TYPE}>")
    return rows.mapInPandas(run, schema).withColumnRenamed("id", doc_id)

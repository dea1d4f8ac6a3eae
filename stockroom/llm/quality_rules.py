"""Quality rules: per-document counts and cross-document line frequency.

DataFrame functions only. The counts of a document (words, symbols, equal
lines, words in repeated windows) are computed inside its row, without a
shuffle. Line frequency works on hashes: a line is normalised (spaces
and digits squeezed to one space, letters lowered), hashed, and the distinct documents that
hold it are counted per host; documents with the same text count once. A
line above its host's limit, a share of the host's distinct texts and a few
texts at least, is boilerplate: it is removed. A document that is depleted by
the removal is rejected: less than half of its characters are left, or fewer
words than any document must have.

Defined results
    null text has no words and fails the base rule; a null host is a host of
    its own; a null id is kept as it is; rows with equal id, host and text
    get equal verdicts; an empty table gives an empty result; extra columns
    are kept by ``cleaned_documents``. A line without a word is no line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockroom.functions.joins import broadcast_if_small
from stockroom.llm.words import SPACE_CHARS, let, word_count, word_list
from stockroom.session import cut_lineage

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
# The characters counted as symbols.
SYMBOL_RE = "[#*$%&|<>]"
LINE_SHARE = 0.05  # a line may stand in this share of a host's distinct texts,
LINE_DOCS = 4  # or in this many of them, whichever is more
LEFT_SHARE = 0.5  # less of a document's characters left: depleted
SPACES_AND_DIGITS = r"[\x20\x09-\x0D0-9]+"


def _window_hashes(words: Column) -> Column:
    def windows(h: Column) -> Column:
        size = F.size(h)
        at = F.sequence(F.lit(0), size - WINDOW)
        hashed = F.transform(at, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)]))
        return F.when(size >= WINDOW, hashed).otherwise(F.array().cast("array<bigint>"))

    return let(F.transform(words, lambda w: F.xxhash64(w)), windows)


def _words_in_repeats(words: Column) -> Column:
    """Words that stand in a window which the text holds twice or more."""

    def covered(starts: Column) -> Column:
        return F.aggregate(
            F.transform(starts, lambda at, k: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, k + 1) - at, F.lit(WINDOW)))),
            F.lit(0), lambda total, n: total + n,
        )

    def repeated(pairs: Column) -> Column:
        twice = F.filter(
            pairs, lambda p, k: (F.get(pairs, k - 1)["h"] == p["h"]) | (F.get(pairs, k + 1)["h"] == p["h"])
        )
        return let(F.array_sort(F.transform(twice, lambda p: p["i"])), covered)

    def count(hashes: Column) -> Column:
        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), let(pairs, repeated)).otherwise(F.lit(0))

    return let(_window_hashes(words), count)


def _equal_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(SPACE_CHARS)) != "")
    return let(lines, lambda found: F.size(found) - F.size(F.array_distinct(found)))


def row_counts(text: Column) -> Column:
    """Struct of n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, chars."""

    def counts(whole: Column) -> Column:
        return let(word_list(whole), lambda words: F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            F.regexp_count(whole, F.lit(SYMBOL_RE)).cast("long").alias("n_symbols"),
            _equal_lines(whole).cast("long").alias("n_dup_lines"),
            _words_in_repeats(words).cast("long").alias("n_repeat_words"),
            F.length(whole).cast("long").alias("chars"),
        ))

    return let(F.coalesce(text, F.lit("")), counts)


def base_failed(counts: str = "") -> Column:
    n, r = F.col(counts + "n_words"), F.col(counts + "n_repeat_words")
    return (n < MIN_WORDS) | (100 * r > MAX_REPEAT_PERCENT * n)


def line_hash(line: Column) -> Column:
    """Hash of the normalised line."""
    return F.xxhash64(F.regexp_replace(F.lower(F.btrim(line, F.lit(SPACE_CHARS))), SPACES_AND_DIGITS, " "))


def row_key(doc_id: str, host: str, text: str) -> Column:
    """64-bit hash of the three columns; a null differs from every value and
    counts at its place (the hash function by itself skips nulls)."""
    columns = (F.col(doc_id).cast("string"), F.col(host).cast("string"), F.col(text))
    return F.xxhash64(*(part for c in columns for part in (c.isNull(), c)))


def line_rows(docs: DataFrame, doc_id: str, host: str, text: str) -> DataFrame:
    """(row, host, body, line, chars, words): one row per distinct line of a
    document with the characters and words of all its places; body is the text's hash."""
    lines = F.filter(F.split(F.col(text), "\n"), lambda line: F.btrim(line, F.lit(SPACE_CHARS)) != "")
    hashed = F.transform(lines, lambda line: F.struct(
        line_hash(line).alias("line"), F.length(line).alias("chars"), word_count(line).alias("words")))
    rows = docs.select(
        row_key(doc_id, host, text).alias("row"), F.col(host).alias("host"), F.xxhash64(F.col(text)).alias("body"),
        F.inline(hashed),
    )
    return rows.groupBy("row", "host", "body", "line").agg(F.sum("chars").alias("chars"), F.sum("words").alias("words"))


def frequent_lines(lines: DataFrame, line_docs: int = LINE_DOCS, line_share: float = LINE_SHARE) -> DataFrame:
    """(at, line): lines above the limit of their host."""
    texts = lines.select("host", "body").distinct().groupBy(F.col("host").alias("of")).count()
    limit = F.greatest(F.lit(line_docs).cast("double"), F.col("count") * line_share)
    limits = broadcast_if_small(cut_lineage(texts.select("of", limit.alias("limit")), "line-limits"))
    # one row for a text, however many copies it has
    held = lines.select("host", "line", "body").distinct().groupBy("host", "line").agg(F.count("*").alias("held"))
    over = held.filter(F.col("held") > line_docs).join(limits, F.col("host").eqNullSafe(F.col("of")))
    return over.filter(F.col("held") > F.col("limit")).select(F.col("host").alias("at"), F.col("line").alias("hot"))


def removals(docs: DataFrame, doc_id: str, host: str, text: str, line_docs: int, line_share: float) -> DataFrame:
    """(row, removed_chars, removed_words, removed_lines) of the documents that lose a line."""
    lines = cut_lineage(line_rows(docs, doc_id, host, text), "lines")
    hot = cut_lineage(frequent_lines(lines, line_docs, line_share), "frequent-lines")
    lost = lines.join(broadcast_if_small(hot), (F.col("line") == F.col("hot")) & F.col("host").eqNullSafe(F.col("at")))
    # equal rows are one row here: their lines carry the places of all copies
    return lost.groupBy("row").agg(
        F.sum("chars").alias("removed_chars"), F.sum("words").alias("removed_words"), F.collect_set("line").alias("removed_lines"))


def judge(docs: DataFrame, doc_id: str = "doc_id", host: str = "source", text: str = "text",
          line_docs: int = LINE_DOCS, line_share: float = LINE_SHARE, left_share: float = LEFT_SHARE) -> DataFrame:
    """One row per document: id, row (its key), the counts, base_failed,
    removed_chars, removed_words, removed_lines, kept."""
    counted = cut_lineage(
        docs.select(doc_id, row_key(doc_id, host, text).alias("row"), row_counts(F.col(text)).alias("c"))
        .select(doc_id, "row", "c.*"),
        "quality-counts",
    )
    copies = counted.groupBy("row").agg(F.count("*").alias("copies"))
    lost = removals(docs, doc_id, host, text, line_docs, line_share).join(copies, "row").select(
        "row", *((F.col(c) / F.col("copies")).cast("long").alias(c) for c in ("removed_chars", "removed_words")), "removed_lines"
    )
    out = counted.join(lost, "row", "left").fillna(0, ["removed_chars", "removed_words"])
    short = F.col("chars") - F.col("removed_chars") < left_share * F.col("chars")
    few = F.col("n_words") - F.col("removed_words") < MIN_WORDS
    depleted = (F.col("removed_chars") > 0) & (short | few)
    return out.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & ~depleted)


def cleaned_documents(docs: DataFrame, doc_id: str = "doc_id", host: str = "source", text: str = "text",
                      chars: str = "n_chars", **limits) -> DataFrame:
    """The documents that are kept, without their boilerplate lines."""
    verdicts = cut_lineage(judge(docs, doc_id, host, text, **limits), "quality-verdicts")
    good = verdicts.filter("kept").select(F.col("row").alias("__row"), F.col("removed_lines").alias("__gone")).distinct()
    rows = docs.withColumn("__key", row_key(doc_id, host, text)).join(good, F.col("__key") == F.col("__row"))
    stays = F.filter(F.split(F.col(text), "\n"), lambda line: ~F.array_contains(F.col("__gone"), line_hash(line)))
    rows = rows.withColumn(text, F.when(F.col("__gone").isNull(), F.col(text)).otherwise(F.array_join(stays, "\n")))
    if chars in docs.columns:
        was = F.when(F.col("__gone").isNull(), F.col(chars)).otherwise(F.length(F.col(text)))
        rows = rows.withColumn(chars, was.cast(docs.schema[chars].dataType))
    return rows.select(*docs.columns)

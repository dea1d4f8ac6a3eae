"""Column expressions shared by the operators: ASCII-space words, let-binding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The white space that ends a word (space, tab to carriage return).
SPACE_CHARS = " \t\n\x0b\x0c\r"
WORD_RE = r"[^\x20\x09-\x0D]+"
SPACE_RE = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    A column used several times, or inside a lambda, may be computed at each
    use once the optimizer merges projections. A lambda variable is computed
    once and then only read.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z; every other character stays."""
    return F.translate(text, UPPER, UPPER.lower())


def word_count(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of ``text`` (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_RE)), F.lit(0)).cast("long")


def word_list(text: Column) -> Column:
    """The words of ``text`` in order (null or blank: empty)."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return let(trimmed, lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, SPACE_RE)))

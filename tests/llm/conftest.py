import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# columns whose names the operators use inside
CLASHES = ["id", "node", "token", "size", "h", "row", "host", "label", "n", "score", "key", "bits", "kept", "at", "c"]
PROSE = "the quick brown fox jumps over the lazy dog while seven other animals watch it from the far side of a wide river"


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and blank texts, a very long text, ties
    and repeated rows."""
    long_text = " ".join(f"word{i}" for i in range(30_000))
    return [
        (1, PROSE, "en", "a", len(PROSE)),
        (1, PROSE, "en", "a", len(PROSE)),
        (2, None, "en", "a", 0),
        (3, "", None, "b", 0),
        (4, " \t\n ", "de", None, 4),
        (None, "no id here but some words all the same", None, None, None),
        (None, None, None, None, None),
        (5, long_text, "en", "a", len(long_text)),
        (6, PROSE, "en", "b", len(PROSE)),
        (7, "ñandú ▁ 梦 😀 \x00 end\n\n12 34!!", "es", "c", 20),
        (8, "x" * 5000, "de", "c", 5000),
    ]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA)


@pytest.fixture(scope="session")
def clashing_docs(odd_docs):
    from pyspark.sql import functions as F

    return odd_docs.select("*", *[F.lit("clash").alias(c) for c in CLASHES])


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)

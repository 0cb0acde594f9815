import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside.
CLASHING = (
    "rank", "hash", "key", "chunk", "bucket", "bands", "words", "h", "shingles", "m", "start", "n_bytes", "n_tokens", "spans",
    "kept", "ids", "score", "rejected", "payload", "digest", "length", "original", "metadata", "quality_", "first",
)


def prose(seed: int, words: int, vocabulary: int = 4000) -> str:
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}x" for _ in range(words))


def odd_documents() -> list[tuple]:
    """Nulls, empty and very long texts, ties, repeated rows, odd characters."""
    a, b = prose(1, 120), prose(2, 90)
    long = prose(3, 30_000, 900)
    rows = [
        (1, a, "en", "s", 10), (2, a, "en", "s", None), (3, a + " tail of it", None, None, 3), (4, b, "de", "t", 4),
        (4, b, "de", "t", 4), (5, None, "en", None, None), (6, "", "fr", "s", 0), (7, " \n\t ", "fr", "s", 3),
        (8, long, "en", "s", 1), (9, "x" * 70_000, "en", "s", 1), (10, "one two", "es", "s", 1),
        (None, b + " more", "es", "s", 1), (None, None, None, None, None), (None, a, None, None, None),
        (11, "éß \U0001f600 İi \x00 \x0b\x0c  naïveﬁ", "fr", "s", 9), (12, "### $$$ !!!", "en", "s", 1),
        (13, "a a a a a a a a a a a a a a a a a a a a a a a a a", "en", "s", 1), (14, "1" * 5_000 + "." * 100, "en", "s", 1),
        (15, "line one\nline one\n\nline one\r\nline two", "en", "s", 1),
    ]
    return rows


@pytest.fixture(scope="session")
def odd(spark):
    """The odd documents with columns whose names clash."""
    df = spark.createDataFrame(odd_documents(), SCHEMA).repartition(3)
    return df.selectExpr("*", *(f"'clash' AS `{c}`" for c in CLASHING))


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def by_row(df, *columns):
    """Sorted tuples."""
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)

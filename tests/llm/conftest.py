import pytest

CLASHING = "id long, key string, hash string, kept boolean, row string, size long, anchor long, piece int, length long, origin string, domain string, score double, n long"
SCHEMA = f"doc_id long, text string, lang string, source string, {CLASHING}"
LONG = " ".join(f"wort{i} das ist" for i in range(30_000))


def fill(rows):
    return [(*r, 1, "k", "h", True, "r", 1, 1, 1, 1, "o", "d", 0.5, 1) for r in rows]


ROWS = [
    (1, "The quick brown fox jumps over the lazy dog near the bank.", "en", "src0"),
    (2, "the QUICK brown fox jumps over the lazy dog near the bank.", "en", "src1"),
    (3, None, None, None),
    (4, "", "de", None),
    (None, "Der schnelle Hund und die Katze.", "de", "src1"),
    (None, "Der schnelle Hund und die Katze.", "de", "src1"),
    (5, LONG, "de", "x"),
    (5, LONG, "de", "x"),
    (6, "12345 !!! \n\n 678", "en", "src2"),
    (7, "naïve Привет мир \U0001f600 <|endoftext|> ça", "fr", "src2"),
    (8, "one", "en", "src0"),
]


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls, empty and very long texts, repeated rows and columns with names that operators use themselves."""
    return spark.createDataFrame(fill(ROWS), SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)

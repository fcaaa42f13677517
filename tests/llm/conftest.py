import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(n, seed):
    """Invented words from a linear congruence."""
    x, out = seed * 2654435761 % 2**32, []
    for _ in range(n):
        x = (1103515245 * x + 12345) % 2**31
        out.append("".join("bcdfglmnprst"[x >> s & 7] + "aeiou"[(x >> s + 3) % 5] for s in (4, 10, 16)))
    return " ".join(out)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows."""
    rows = [
        (1, None, None, None, None),
        (2, "", "en", "a", 0),
        (3, " \t\n ", "en", "a", 4),
        (4, words(40, 1), "en", "a", None),
        (5, words(40, 1), "en", "b", 1),
        (5, words(40, 1), "en", "b", 1),
        (None, words(30, 2), "fr", "b", 1),
        (6, words(30_000, 3), "de", None, 1),
        (7, "x" * 200_000, None, "c", 200_000),
        (8, "é 日本 😀   " + words(20, 4), "fr", "c", 1),
        (9, "12345 !!! 678", "en", "c", 13),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def clashing(odd_docs):
    """Extra columns with names that the operators use themselves."""
    from pyspark.sql import functions as F

    names = "id h k t t2 fp s n cell side size start score tokens lang_pred rejected spans shard slot block key _n _k _b host html wrapper v c dim".split()
    return odd_docs.withColumns({n: F.lit("clash") for n in names if n not in odd_docs.columns})

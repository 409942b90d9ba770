import pytest


@pytest.fixture(autouse=True)
def workers(spark):
    from lendfeat.llm import prepare

    prepare(spark)


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, slot int, score double, size int, n long, cls int, hash int, offset int"


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls, empty and long texts, repeated rows and clashing extra columns."""
    rows = [
        (1, "the quick brown fox jumps over the lazy dog near the river bank", "en", "a"),
        (1, "the quick brown fox jumps over the lazy dog near the river bank", "en", "a"),
        (2, "the quick brown fox jumps over the lazy dog near the river bank", "en", None),
        (3, None, "en", "a"), (4, "", None, "b"), (5, " \n\t ", "de", "b"), (None, "der schnelle braune Fuchs springt", "de", None),
        (6, "word " * 60_000, "en", "c"), (7, "123 456 !!", "en", "c"), (8, "a", "en", "\U0001F600"), (9, "\x01\x02 é", "fr", "c"),
    ]
    return spark.createDataFrame([(*r, 0, 1, 0.5, 2, 3, 4, 5, 6) for r in rows], SCHEMA).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)

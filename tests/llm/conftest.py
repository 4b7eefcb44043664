import pytest

EXTRA = "key long, kept boolean, score double, source_ string, mix_epoch long, bands string"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(n, seed=0):
    """n different words."""
    return " ".join(f"w{seed}x{i}" for i in range(n))


@pytest.fixture(scope="session")
def messy(spark):
    """Documents with nulls in every column, empty and long texts, ties, repeated rows, and extra columns."""
    long_text = words(30_000, 9)
    rows = [
        (1, words(60), "en", "a", 1),
        (2, words(60), "en", "a", 1),  # a copy
        (3, words(60) + " tail", None, None, None),  # a near copy
        (4, None, "en", "b", None),
        (5, "", "fr", "b", 0),
        (6, " \n\t ", "fr", None, 4),
        (None, words(60), "en", "a", 1),
        (None, None, None, None, None),
        (7, long_text, "de", "c", 9),
        (8, "é" * 100, "fr", "c", 100),
        (9, words(25, 3) + "\n" + words(25, 3), "en", "b", 7),
        (9, words(25, 3) + "\n" + words(25, 3), "en", "b", 7),  # the row again
        (10, "mail a.b@c.org or +49 30 1234567, card 4111 1111 1111 1111 at 10.0.0.1", "en", "a", 5),
    ]
    return spark.createDataFrame([(*r, i, None, float(i), "x", 5, None) for i, r in enumerate(rows)], f"{DOCS}, {EXTRA}")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)

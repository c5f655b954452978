import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(("th", "an", "er", "in", "on", "st", "re", "ou")) for _ in range(rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls in any column, empty and very long texts, copies, ties and repeated rows."""
    base = words(1, 120)
    near = base.split()
    near[60] = "changed"
    rows = [
        (1, base, "en", "a"), (2, base, "en", None), (2, base, "en", None), (3, " ".join(near), None, "b"),
        (4, None, "en", "a"), (5, "", None, None), (6, " \n\t ", "fr", "a"), (7, "one two", "en", "a"), (8, "ONE\ttwo", "en", "a"),
        (9, words(2, 6000), "de", "c"), (10, words(3, 80) + "\n" + words(3, 80), "en", "c"), (None, words(4, 70), "en", "d"),
        (11, "Étude ünïcode 🎉 naïve " * 30, "fr", "e"), (12, "a" * 3000, "en", "e"), (13, words(5, 90), "xx", "e"),
    ]
    return [(i, t, lang, source, None if t is None else len(t)) for i, t, lang, source in rows]


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    """The rows with further columns whose names the operators use themselves."""
    return spark.createDataFrame(edge_rows, DOCS).selectExpr("*", "1 as n", "'x' as set_id", "2 as kept", "3 as score", "4 as gate", "array(1) as spans", "'k' as text_key")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)

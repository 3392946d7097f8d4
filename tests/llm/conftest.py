import pytest


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with every odd case, and columns whose names clash with those the operators use."""
    rows = [
        (1, "The quick brown fox jumps over the lazy dog near the old river bank today.", "en", "a"),
        (1, "The quick brown fox jumps over the lazy dog near the old river bank today.", "en", "a"),  # a repeated row
        (2, "THE QUICK BROWN FOX jumps, over the lazy dog near the old river bank today!", "en", None),  # the same words
        (3, None, None, None),
        (4, "", "en", "b"),
        (5, "   \n\n \t ", "en", "b"),
        (6, "one two", "en", "b"),
        (7, "12 34 -- 56", None, "b"),
        (8, "Das ist ein Haus und der Garten ist schön, nicht wahr?", "de", "c"),
        (9, " ".join(f"word{i % 97}x{i % 31}" for i in range(30_000)), "en", "c"),  # very long
        (10, "Das ist ein Haus und der Garten ist schön, nicht wahr!", "de", "c"),
        (None, "a row without an id", "en", "c"),
    ]
    names = "doc_id long, text string, lang string, source string"
    return spark.createDataFrame([(*r, 1.0, 2, True, "x", 7) for r in rows],
                                 f"{names}, score double, block int, held_out boolean, word string, id int")


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")

import pytest


@pytest.fixture
def docs(spark):
    """Documents with nulls, empties, repeated rows, ties and an extra column whose name clashes with inner ones."""
    rows = [(1, "One two three four five six seven.", "en", "a", 34, "x"), (1, "One two three four five six seven.", "en", "a", 34, "x"),
            (2, "one TWO three four five six seven.", "en", "b", 34, "y"), (3, None, None, None, None, None), (4, "", "en", "a", 0, "z"),
            (None, "no id here at all", "en", "c", 17, "n"), (5, "word " * 30_000, "en", "c", 150_000, "long"),
            (6, "Mail bob.lee@mail1.example.com or +1 (017) 555-7713.\nReleased under the MIT License.", "en", "b", 80, "p")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string")


@pytest.fixture
def no_docs(docs):
    return docs.where("false")

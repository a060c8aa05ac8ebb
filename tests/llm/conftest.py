import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of the given (doc_id, text) rows, with columns that clash with inner names."""

    def make(rows, lang="en"):
        data = [(i, t, lang, "s", len(t or ""), "x", 1) for i, t in rows]
        return spark.createDataFrame(data, DOCS + ", node string, bucket int")

    return make


@pytest.fixture(scope="session")
def odd():
    """Nulls, empty and long texts, ties and repeated rows."""
    long = " ".join(f"word{i % 700}x{i % 13}" for i in range(30_000))
    return [
        (1, None), (2, ""), (3, " \t\n"), (4, "One two three four five six."), (4, "One two three four five six."),
        (5, "One two three four five six."), (None, "no key here"), (6, long), (7, "é ß İ Σίσυφος 中文 \U0001f600 \x1c x\x00y"), (8, "tie"), (9, "tie"),
    ]

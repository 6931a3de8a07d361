"""Small tables with the awkward rows every operator must take."""

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, TEXT string, score int, n_tokens string"


def doc(i, text, source="s", lang="en"):
    return (i, text, lang, source, None if text is None else len(text), "other", 7, "x")


@pytest.fixture(scope="session")
def awkward(spark):
    """Null ids and texts, empty and blank texts, ties, repeated rows, a long text, clashing names."""
    long = " ".join(f"word{i % 997}" for i in range(20_000))
    rows = [doc(None, "a null id has a text"), doc(None, None), doc(1, None), doc(2, ""), doc(3, " \n\t "), doc(4, "the same text here\nwith two lines."), doc(5, "the same text here\nwith two lines."), doc(5, "the same text here\nwith two lines."), doc(6, long, None), doc(7, "x" * 3000), doc(8, "é　日本 \x1c<|endoftext|> 1\r\n  two  spaces", None, None), doc(9, "one"), doc(10, "One")]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)

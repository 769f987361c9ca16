import pytest

LONG = "word other thing " * 20_000


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Every odd row: NULLs anywhere, empty, blank, very long, repeated rows, repeated ids; columns with clashing names."""
    rows = [(1, "one two three four five six", "en"), (1, "one two three four five six", "en"), (2, None, "en"), (3, "", None),
            (4, " \n\t ", "xx"), (None, "a b c", "en"), (None, None, None), (5, LONG, "en"), (6, "one", "de"), (7, "héé ñ 漢字 😀", "fr"),
            (8, "ONE two THREE four five six", "en")]
    return spark.createDataFrame([(i, t, lang, "src", len(t or ""), "x", 1, "y") for i, t, lang in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, row string, score int, cls string")


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)

import pytest

#: Texts that every operator on documents must take: null, empty, blank, repeated rows, null identifiers, ties, a very long one.
ODD = [
    (1, None), (2, ""), (3, " \t\n"), (4, "One two three four five."), (4, "One two three four five."), (None, "one two three four five."),
    (None, None), (5, "ONE TWO THREE FOUR FIVE."), (6, "x" * 30_000), (7, "word " * 20_000), (8, "éñß 🙂 中文    a\r\nb\x1cc"), (9, "\n\n\n"),
]


@pytest.fixture()
def odd_docs(spark):
    """The odd texts in a table with further columns whose names an operator may use inside or return."""
    rows = [(i, t, "x", 1.0, 3, True, "k", [1], 5) for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score double, n_tokens int, kept boolean, keep_id string, ids array<int>, n_lines int")


@pytest.fixture()
def no_docs(odd_docs):
    return odd_docs.limit(0)

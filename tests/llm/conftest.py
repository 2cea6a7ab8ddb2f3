"""What the tests of this folder share: tables of odd rows."""

import pytest


@pytest.fixture
def documents(spark):
    """Makes a documents table of texts, with an extra column whose name an operator might use."""

    def make(texts, ids=None, sources=None):
        rows = [(i if ids is None else ids[i], t, "en", (f"s{i % 3}" if sources is None else sources[i]), None if t is None else len(t), "kept") for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string").repartition(3)

    return make


#: Nulls, empties, white space, ties, a very long text.
ODD = [None, "", " \n\t", "same text here", "same text here", "SAME text here", "é ü 漢字 😀", "x" * 50_000, "one two three four five six seven " * 3000]

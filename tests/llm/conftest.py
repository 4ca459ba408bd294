import pytest

from lakemarts.llm import common


@pytest.fixture(scope="session")
def ready(spark):
    common.ship(spark)
    return spark


# A table of documents with everything that may go wrong in it.
LONG = " ".join(f"word{i % 4999} and some more of it" for i in range(30_000))
EDGE_TEXTS = [
    (1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, "!!! ... ???"), (6, LONG), (6, LONG), (7, "same text here now"),
    (8, "same text here now"), (None, "no id"), (None, None), (9, "a" * 50_000), (10, "\u0000 � \U0001f600 é"),
]


@pytest.fixture(scope="session")
def edge_docs(ready):
    """Nulls, empty and very long texts, repeated rows, clashing names."""
    rows = [(i, t, None, "src", 0, 1.0, "x", True) for i, t in EDGE_TEXTS]
    return ready.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, score double, label string, kept boolean"
    )


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.where("false")

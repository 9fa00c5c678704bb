from __future__ import annotations

import pytest

from tidemark.llm.common import ship, table

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def documents(spark):
    return table(spark, SMALL, "documents")


@pytest.fixture(scope="session")
def texts(documents):
    """{doc_id: text} of the small table."""
    return {r.doc_id: r.text or "" for r in documents.select("doc_id", "text").collect()}


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns named like results."""
    words = " ".join(f"word{i % 700} of" for i in range(30_000))
    rows = [
        (1, "A plain text. It has two sentences.", "en", "a", 35),
        (1, "A plain text. It has two sentences.", "en", "a", 35),
        (2, None, None, None, None),
        (3, "", "en", None, 0),
        (4, words, None, "a", None),
        (None, "A text without an id, and with é and 　 wide space.", "en", "a", 1),
        (5, " \n\t ", "xx", "b", 1),
        (6, "same same same same same same " * 20, "en", "a", 1),
        (7, "same same same same same same " * 20, "en", "a", 1),
        (8, "#" * 500, "en", "a", 500),
    ]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    frame = spark.createDataFrame(rows, schema)
    return frame.selectExpr("*", "7 AS kept", "'x' AS score", "1.5 AS n_words", "'y' AS component_id")


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)

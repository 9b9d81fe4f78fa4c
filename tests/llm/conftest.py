from __future__ import annotations

import pytest

from starloom.llm.queries import vocabulary

#: Rows of every shape an operator must take: null and empty texts, blank ones, ties, repeats, null ids.
ODD = [
    (1, "a b c d e f g h"),
    (2, "a b c d e f g h"),
    (2, "a b c d e f g h"),
    (3, None),
    (4, ""),
    (5, " \n\t \r\n"),
    (6, "A B C d e f G h"),
    (7, "héllo wörld ñ 漢字 😀 <|endoftext|> x"),
    (None, "a b c d e f g h"),
    (None, None),
    (8, "word"),
    (9, "=" * 5000),
    (10, "\n\n\n\n"),
]


@pytest.fixture(scope="session")
def vocab():
    return vocabulary()


@pytest.fixture
def odd(spark):
    """The odd rows, with columns whose names operators use inside."""
    rows = [(i, t, "x", 1, None, 2.5) for i, t in ODD]
    return spark.createDataFrame(
        rows, "doc_id LONG, text STRING, digest STRING, length INT, `group` STRING, score DOUBLE"
    )


@pytest.fixture
def nothing(odd):
    return odd.where("false")


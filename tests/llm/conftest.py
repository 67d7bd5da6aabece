from __future__ import annotations

import pytest

LAYOUT = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def documents(spark):
    """Builds a table of documents from (doc_id, text) or (doc_id, text, lang, source)."""

    def build(*rows: tuple):
        full = [(*r, *(None, None)[: 4 - len(r)], len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, LAYOUT)

    return build


@pytest.fixture
def hard_documents(documents):
    """NULLs in every column, empty, blank and long texts, repeated rows, extra columns."""
    long = " ".join(f"word{k} and then more" for k in range(3000))
    rows = [
        (1, "the quick brown fox jumps over the lazy dog", "en", "a"),
        (2, None, None, None),
        (3, "", "en", "a"),
        (4, " \n\t ", "de", None),
        (5, long, "en", "a"),
        (5, long, "en", "a"),
        (None, "a text without an id", "en", "b"),
        (None, "a text without an id", "en", "b"),
        (6, "漢字 \U0001f600 é <|endoftext|> </s> \x00 \xa0  x", None, "b"),
        (7, "12 34 !!", "fr", "c"),
    ]
    from pyspark.sql import functions as F

    return documents(*rows).withColumns({"rank": F.lit(1), "fp": F.lit("x"), "score": F.lit("y"), "n": F.lit(2), "run": F.lit(3)})


@pytest.fixture
def no_documents(spark):
    return spark.createDataFrame([], LAYOUT)

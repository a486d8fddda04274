"""Rows and fixtures that the tests of the training-data operators share."""

from __future__ import annotations

import pytest

SF = "/root/testdata/sf0.001"
LONG = "word and another one " * 40_000

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def doc_rows(texts):
    return [(i, t, "en", f"s{i % 3}", len(t) if t is not None else None) for i, t in enumerate(texts)]


@pytest.fixture
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, repeated rows, a clashing extra column."""
    rows = doc_rows(["", None, "one", "same text here, twice over", LONG])
    rows += [rows[3], (None, "no id", None, None, None), (None, None, None, None, None), (7, "odd \x1c 　 🙂 <|endoftext|> x\r\ny", "de", None, 5)]
    rows = [(*r, "extra", 1) for r in rows]
    return spark.createDataFrame(rows, DOCS + ", kept string, n_words long")


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], DOCS)

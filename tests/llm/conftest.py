from __future__ import annotations

import pytest
from pyspark.sql import types as T

#: Columns of documents, and two whose names clash with what operators use or return.
DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("kept", T.StringType()),
        T.StructField("shard", T.StringType()),
    ]
)

LONG = " ".join(f"word{i % 97}x{i % 89}" for i in range(12_000))


@pytest.fixture
def documents(spark):
    """Makes a documents table of (doc_id, text[, lang[, source]]) rows."""

    def make(rows):
        full = []
        for row in rows:
            doc_id, text, lang, source = (*row, None, None)[:4]
            full.append((doc_id, text, lang, source, None if text is None else len(text), "a", None))
        return spark.createDataFrame(full, DOCUMENTS)

    return make


@pytest.fixture
def odd_rows():
    """NULLs in every column, empty and very long texts, ties, repeated rows."""
    return [
        (None, None), (1, None), (2, ""), (2, ""), (3, LONG), (4, LONG), (None, "same text"), (None, "same text"),
        (5, "same text", "en", "a"), (6, "Same TEXT", "en", "a"), (7, "\x00 \t\r\n", "xx", "b"), (8, "漢字 😀 ▁", "zh", "b"), (8, "漢字 😀 ▁", "zh", "b"),
    ]

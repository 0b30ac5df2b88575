from __future__ import annotations

import pytest

from corpora import SCHEMA


@pytest.fixture
def make_docs(spark):
    """Documents from (doc_id, text[, lang[, source]]), with columns whose names the operators use inside."""

    def make(rows):
        full = []
        for row in rows:
            doc_id, text, lang, source = (*row, None, None)[:4] if len(row) < 4 else row[:4]
            full.append((doc_id, text, lang, source, None if text is None else len(text), 7, "x", "y", 1, 2, 3, 4))
        return spark.createDataFrame(full, SCHEMA)

    return make

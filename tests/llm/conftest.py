from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, n int"


@pytest.fixture
def make_docs(spark):
    """Documents from (doc_id, text) pairs, with extra columns whose names clash with working names."""
    def make(pairs):
        rows = [(i, t, "en" if i else None, f"s{(i or 0) % 3}", len(t or ""), "x", 1) for i, t in pairs]
        return spark.createDataFrame(rows, SCHEMA)
    return make

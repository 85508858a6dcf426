from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source) rows, with a column that means nothing."""

    def make(rows):
        full = [(r[0], r[1], *(r[2:] or ("en", "a")), None) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make

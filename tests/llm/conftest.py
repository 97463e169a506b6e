from __future__ import annotations

import pytest

TEXT = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def documents(spark):
    """Documents from texts; ids count up from 0 unless they are given."""

    def make(texts, ids=None):
        ids = range(len(texts)) if ids is None else ids
        rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in zip(ids, texts, strict=True)]
        return spark.createDataFrame(rows, TEXT)

    return make

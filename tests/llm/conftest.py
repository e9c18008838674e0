from __future__ import annotations

import pytest

from martweave.llm.queries import shipped


@pytest.fixture
def documents(spark):
    """Make documents of texts; ids count from 0 unless they are given."""

    def make(texts, ids=None, **more):
        ids = range(len(texts)) if ids is None else ids
        rows = [(i, t, *(v[k] for v in more.values())) for k, (i, t) in enumerate(zip(ids, texts))]
        kinds = ", ".join(["doc_id long", "text string", *(f"`{c}` string" for c in more)])
        return shipped(spark).createDataFrame(rows, kinds)

    return make

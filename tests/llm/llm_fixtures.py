"""Fixtures of the tests in this folder, which import them by name."""

import pytest


@pytest.fixture
def documents(spark):
    """A table of documents with clashing extra columns from ``(doc_id, text)`` rows."""

    def build(rows):
        rows = rows.items() if isinstance(rows, dict) else rows
        return spark.createDataFrame(
            [(i, t, "x", 1, 2.0) for i, t in rows],
            "doc_id bigint, text string, key string, at int, drop double",
        )

    return build

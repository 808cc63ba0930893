"""Small tables for the operators on training data."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from llm_helpers import DOCS  # noqa: E402


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text) or (doc_id, text, source)."""

    def build(rows, extra=""):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        table = spark.createDataFrame(full, DOCS)
        for name in extra.split():
            table = table.withColumn(name, table.doc_id.cast("string"))
        return table

    return build

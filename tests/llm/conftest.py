from __future__ import annotations

import pytest

from alula.session import ship_package


@pytest.fixture(autouse=True)
def _shipped(spark):
    ship_package(spark)


@pytest.fixture
def documents(spark):
    """Rows (doc_id, text[, lang[, source]]) as a documents table with columns that could clash with an operator's own."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, r[3] if len(r) > 3 else None, len(r[1] or ""), "x", 1) for r in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, score string, component_id int")

    return make

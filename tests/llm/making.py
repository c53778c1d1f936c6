"""A fixture that the tests of this folder import."""

from __future__ import annotations

import pytest

SMALL, MEDIUM, LARGE = (f"/root/testdata/sf{x}" for x in ("0.001", "0.01", "0.1"))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make(spark):
    """A documents table from texts (or (doc_id, text) pairs), with columns whose names clash."""

    def table(rows, extra: str = ""):
        rows = [row if isinstance(row, tuple) else (i, row) for i, row in enumerate(rows)]
        full = [(i, t, None, "s", None, *([7] if extra else [])) for i, t in rows]
        return spark.createDataFrame(full, SCHEMA + (f", {extra} int" if extra else ""))

    return table

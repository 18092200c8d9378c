import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


@pytest.fixture(scope="module")
def docs_of(spark):
    """A documents table from (doc_id, text) pairs, with extra columns whose names clash with internal ones."""
    def make(rows, source=None):
        schema = "doc_id long, text string, lang string, source string, n_chars long, node string, hub string, size int, fp string"
        full = [(i, t, "en", (source or (lambda k: "s"))(i), None if t is None else len(t), "x", "y", 3, "z") for i, t in rows]
        return spark.createDataFrame(full, schema)
    return make

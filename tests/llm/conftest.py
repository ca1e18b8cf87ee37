import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

EMPTY_DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def empty_docs(spark):
    return spark.createDataFrame([], EMPTY_DOCS)


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) pairs, with an extra column of a clashing name."""

    def make(pairs):
        rows = [(d, t, "en", f"src{k % 3}" if k % 5 else None, len(t or ""), f"x{k}") for k, (d, t) in enumerate(pairs)]
        return spark.createDataFrame(rows, EMPTY_DOCS + ", uid string").repartition(3)

    return make

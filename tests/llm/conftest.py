import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def documents(spark):
    """A frame of (doc_id, text) rows."""

    def make(rows, extra=""):
        return spark.createDataFrame(rows, f"doc_id long, text string{extra}")

    return make

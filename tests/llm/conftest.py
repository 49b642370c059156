import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")


@pytest.fixture
def make(spark):
    """A documents table with extra columns, two of them named as an operator's own."""

    def build(texts, ids=None, langs=None):
        rows = [(i if ids is None else ids[i], t, langs[i] if langs else None, "s", 0, 7, "b") for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, shard int, block string")

    return build


@pytest.fixture
def sf(spark):
    return "/root/testdata/sf0.001"

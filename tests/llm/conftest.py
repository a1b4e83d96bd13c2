import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs_of(spark):
    """DataFrame of documents from (id, text) pairs, with the columns of ``documents`` and a clashing one."""
    def make(pairs, lang=None):
        rows = [(i, t, lang[k] if lang else "en", "src", None if t is None else len(t), 7)
                for k, (i, t) in enumerate(pairs)]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, "
                                           "n_chars long, score int")
    return make

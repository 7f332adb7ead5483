import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


@pytest.fixture(scope="session")
def spark():
    from skyledger.session import build_session
    s = build_session("local[4]", app="skyledger-llm-tests", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="skyledger-llm-ckpt-")})
    s.sparkContext.setLogLevel("ERROR")
    yield s


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Makes a documents table of (doc_id, text) pairs; other columns are filled, some with nulls."""
    def make(rows):
        return spark.createDataFrame(
            [(i, t, None if k % 3 else "en", f"src{k % 2}", None if t is None else len(t)) for k, (i, t) in enumerate(rows)],
            DOCS)
    return make

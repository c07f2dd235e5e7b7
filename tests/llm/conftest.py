import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
if ROOT not in sys.path:
    sys.path.append(ROOT)  # for corpus_pipeline

from llm_paths import SF_DIR  # noqa: E402


@pytest.fixture(scope="session")
def table(spark):
    """Rows of a test table as dictionaries."""
    cache = {}

    def rows(name):
        if name not in cache:
            cache[name] = [r.asDict() for r in spark.read.parquet(f"{SF_DIR}/{name}.parquet").collect()]
        return cache[name]

    return rows


@pytest.fixture
def docs(spark):
    """A small documents table from (id, text[, source]) rows, with columns of clashing names."""
    def make(*rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "s", "other", 7) for r in rows]
        return spark.createDataFrame(
            full, "doc_id bigint, text string, source string, uid string, `doc` int")
    return make

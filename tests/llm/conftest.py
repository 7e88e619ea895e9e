import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty, long and repeated texts, a repeated id, and extra columns with the names the operators use inside."""
    base = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(1, None, "en", None), (2, "", None, "a"), (3, base, "en", "a"), (3, base, "en", "a"), (None, base, "en", "a")]
    rows += [(5, "x" * 20000, "en", "a"), (6, "word " * 30000, "en", "a"), (7, "a@b.co +1 (323) 555-9830 10.0.0.1", "en", "b")]
    extra = [(i, t, k, s, len(t or ""), 1, 2, "r", "v", 0.5) for i, t, k, s in rows]
    kind = "doc_id bigint, text string, lang string, source string, n_chars bigint, row int, part int, verdict string, base_spans string, score double"
    return spark.createDataFrame(extra, kind)

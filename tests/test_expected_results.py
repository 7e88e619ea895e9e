"""Every registered query against its SQL on the smallest data set."""

import pytest
from table_paths import SF_DIR

from __spark_entry__ import oracle_sql, queries
from check import compare, connect


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, duck, name):
    df = queries()[name](spark, SF_DIR)
    rows = df.collect()
    if name in oracle_sql():
        assert compare(df, rows, oracle_sql()[name], duck) == ""
    else:
        assert rows


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())

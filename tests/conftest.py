import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from table_paths import SF_DIR  # noqa: E402



@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pressbeat.session import local_session

    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session(4, **{"spark.checkpoint.dir": shared, "spark.sql.warehouse.dir": f"{shared}/warehouse"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from pressbeat.tables import Tables

    return Tables(spark, SF_DIR)

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

from chronofold.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    session = local_session(4, "chronofold-tests", **{
        "spark.sql.warehouse.dir": str(warehouse),
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("work"))})
    yield session
    session.stop()

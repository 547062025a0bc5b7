"""The session of the operators' tests: the parent's, with a temporary checkpoint folder."""

import pytest


@pytest.fixture(scope="session")
def shared(spark, tmp_path_factory):
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    return spark

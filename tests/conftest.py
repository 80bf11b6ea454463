import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from dinerlake.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    checkpoints = tmp_path_factory.mktemp("checkpoints")
    session = local_session(
        "dinerlake-tests", 4,
        **{
            "spark.checkpoint.dir": str(checkpoints),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.driver.memory": "4g",
            "spark.sql.maxMetadataStringLength": "5000",
        },
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def work(spark):
    from verification.workspace import Workspace

    return Workspace(spark, SMALL)

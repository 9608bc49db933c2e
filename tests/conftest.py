import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from culvert.session import build_session  # noqa: E402

TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    settings = {
        "spark.master": "local[8]",
        "spark.driver.memory": "8g",
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    }
    session = build_session("culvert-tests", **settings)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from granary.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = build_session("granary-tests", "local[8]", {
        "spark.sql.shuffle.partitions": 8,
        "spark.ui.enabled": False,
        "spark.driver.memory": "8g",
        "spark.sql.warehouse.dir": str(base / "warehouse"),
        "spark.checkpoint.dir": str(base / "scratch"),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")

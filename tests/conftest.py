import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from touchline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = build_session(
        "touchline-tests", "local[8]",
        **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g",
           "spark.ui.showConsoleProgress": "false", "spark.checkpoint.dir": str(folder / "checkpoints"),
           "spark.sql.warehouse.dir": str(folder / "warehouse")})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def world(tmp_path_factory):
    from tests.football import World
    return World(tmp_path_factory.mktemp("football"))

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pavelake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    """The session of the jobs, with RocksDB state and changelog checkpoints."""
    session = build_session("tests", "local[4]", conf={
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "6g",
        # Plans are asserted as text and must not be cut short.
        "spark.sql.maxMetadataStringLength": "10000",
        "spark.sql.debug.maxToStringFields": "500",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lake(tmp_path):
    return str(tmp_path / "lake")

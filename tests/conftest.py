import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidelog.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "local[8]",
        app="tests",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.streaming.stateStore.maintenanceInterval": "600s",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lines(spark):
    """DataFrame of raw lines from (file, text, ...) pairs, positions counted up."""

    def make(*rows):
        data = [(name, i, text) for i, (name, text) in enumerate(rows)]
        return spark.createDataFrame(data, "file_name string, pos bigint, value string")

    return make

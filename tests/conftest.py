import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tabloom import runtime  # noqa: E402
from tabloom.operators import quantiles  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = runtime.session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def small_limits(monkeypatch):
    """Force the paths for large tables."""
    monkeypatch.setattr(runtime, "BROADCAST_ROWS", 20)
    monkeypatch.setattr(quantiles, "GATHERED_ROWS", 20)

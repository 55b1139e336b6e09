import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ledgerloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "ledgerloom-tests", f"local[{min(8, os.cpu_count() or 1)}]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
           "spark.driver.memory": "6g", "spark.sql.streaming.stopTimeout": "30s"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()

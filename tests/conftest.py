from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from orderloom.session import release_scratch, spark_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = spark_session(
        "local[8]",
        "orderloom-tests",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.driver.host": "127.0.0.1",
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    release_scratch(session)
    session.stop()

from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

from roadpulse import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    settings = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "6g",
        "spark.sql.streaming.ui.enabled": "false",
    }
    session = get_spark(
        "roadpulse-tests", master="local[8]", shuffle_partitions=4, extra=settings
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def plan():
    """Text of the physical plan of a batch table."""

    def text(rows) -> str:
        return rows._jdf.queryExecution().executedPlan().toString()

    return text

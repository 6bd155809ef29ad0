"""Shared session; staged tables go to the folder the test run owns."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from ledgerloom.session import build_session

    folder = tmp_path_factory.mktemp("shared")
    session = build_session(
        "tests", "local[8]", 4,
        {
            "spark.ui.enabled": "false", "spark.driver.memory": "6g", "spark.checkpoint.dir": str(folder),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)

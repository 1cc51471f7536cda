from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from meterline.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", spark__sql__shuffle__partitions="8")
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def tables():
    return "/root/testdata/sf0.01"


@pytest.fixture
def stamp(spark):
    """A timestamp literal column maker for readable fixtures."""
    from datetime import datetime

    return lambda text: datetime.fromisoformat(text)

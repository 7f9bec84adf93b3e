from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pulsegrid.session import clear_scratch, local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", "4", **{"spark.sql.shuffle.partitions": "4"})
    yield session
    clear_scratch(session)
    session.stop()


@pytest.fixture(scope="session")
def sf() -> str:
    return SF

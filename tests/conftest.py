from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ.setdefault("GRITSTONE_PARTITIONS", "4")


@pytest.fixture(scope="session")
def spark():
    from gritstone.session import build_session

    s = build_session("tests", 4, "4g")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()

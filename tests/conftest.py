from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import local_session

    return local_session("tests")


@pytest.fixture(scope="session")
def tables(spark):
    from tidemark.sources.fixtures import Tables

    return Tables(spark, SMALL)

from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL_SF = os.environ.get("HAVEN_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from haven.session import build_session
    s = build_session("local[4]", app="haven-tests", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL_SF


@pytest.fixture()
def scratch(spark):
    """A fresh folder under the session's shared folder."""
    from haven.session import job_dir
    return job_dir(spark, "test")

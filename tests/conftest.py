from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quarry.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = build_session(master="local[4]", app_name="quarry-tests", shuffle_partitions=8)
    yield session
    session.stop()


@pytest.fixture()
def tmp_dir():
    """A fresh scratch folder per test (never cleared, never reused)."""
    return tempfile.mkdtemp(prefix="quarry-test-")

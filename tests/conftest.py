from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stratalake.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=4, memory="4g")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    """A new folder per test, as text."""
    return str(tmp_path)

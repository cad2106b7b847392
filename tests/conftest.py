import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from hitscope.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=8, app_name="hitscope-tests")
    yield session


@pytest.fixture(scope="session")
def scratch():
    """A fresh folder per test session (never cleared)."""
    return tempfile.mkdtemp(prefix="hitscope-test-")

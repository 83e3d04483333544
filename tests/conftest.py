import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from marlstone.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests", spark__sql__warehouse__dir="/tmp/marlstone-test-warehouse")
    yield session
    session.stop()

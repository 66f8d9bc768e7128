import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from riskrules.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("riskrules-tests", "8")


@pytest.fixture(scope="session")
def folder():
    return os.environ.get("RISKRULES_TEST_DATA", "/root/testdata/sf0.01")

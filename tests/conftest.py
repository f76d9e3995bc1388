import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


EVENT_LOG_DIR = tempfile.mkdtemp(prefix="strata-eventlog-")


@pytest.fixture(scope="session")
def spark():
    return local_session("*", 8, app="strata-tests", event_log_dir=EVENT_LOG_DIR)


@pytest.fixture(scope="session")
def event_log_dir():
    return EVENT_LOG_DIR


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL

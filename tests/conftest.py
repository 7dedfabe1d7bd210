import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from closure_engine.session import build_session  # noqa: E402
from tools.event_log import settings  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    log = str(tmp_path_factory.mktemp("events"))
    s = build_session("local[4]", shuffle_partitions=8, app_name="closure_engine_tests", extra=settings(log))
    yield s
    s.stop()

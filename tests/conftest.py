import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pulseframe.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_spark(
        "tests",
        master="local[4]",
        **{"spark__sql__shuffle__partitions": "4", "spark__ui__enabled": "false",
           "spark__driver__memory": "6g", "spark__sql__session__timeZone": "UTC"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()

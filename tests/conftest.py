import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from postpulse.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    running = session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="6g",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="postpulse-tests-"),
    )
    running.sparkContext.setLogLevel("ERROR")
    yield running
    running.stop()

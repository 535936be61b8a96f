from __future__ import annotations

import os
import signal
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = os.pathsep.join([str(ROOT), os.environ.get("PYTHONPATH", "")])


@pytest.fixture(scope="session")
def spark():
    from stratawork.session import build_session

    s = build_session("tests", 4, 4)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(autouse=True)
def limit():
    """A test that takes ten minutes hangs: it fails then, and the others go on."""

    def over(*_):
        raise TimeoutError("the test took ten minutes")

    signal.signal(signal.SIGALRM, over)
    signal.alarm(600)
    yield
    signal.alarm(0)

import os
import sys
from pathlib import Path

import pytest

TOP = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(TOP))
os.environ["PYTHONPATH"] = f"{TOP}{os.pathsep}{os.environ.get('PYTHONPATH', '')}"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from textmill.plans.session import session

    s = session("4", 4)
    s.sparkContext.setLogLevel("ERROR")
    s.sparkContext.setCheckpointDir(f"file://{tmp_path_factory.mktemp('checkpoints')}")
    yield s
    s.stop()

import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from dealsieve.session import build_session
    s = build_session("local[4]", shuffle_partitions=8)
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="dealsieve-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="dealsieve-test-")

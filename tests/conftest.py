import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rollscore.session import build_session, ensure_checkpoint_dir  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[*]", shuffle_partitions=8)
    ensure_checkpoint_dir(s, tempfile.mkdtemp(prefix="rollscore-test-ckpt-"))
    yield s
    s.stop()

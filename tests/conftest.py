import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cartflow.session import checkpoint_dir, get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session(app="cartflow-tests", master="local[*]", shuffle_partitions=8)
    checkpoint_dir(s)
    yield s
    s.stop()


SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tableprep.session import get_session
    s = get_session(master="local[4]", shuffle_partitions=8, app="tableprep-tests", driver_memory="4g")
    yield s
    s.stop()


SF_SMALL = "/root/testdata/sf0.001"

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from lakelens.session import local_session

    s = local_session("*", partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small_dir():
    return SMALL

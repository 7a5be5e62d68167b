import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from storyloom.session import local_session


@pytest.fixture(scope="session")
def spark():
    return local_session("*", shuffle_partitions=4)


@pytest.fixture(scope="session")
def tiny():
    return "/root/testdata/sf0.001"

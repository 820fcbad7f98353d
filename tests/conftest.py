import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parents[1]), str(Path(__file__).parent)]


@pytest.fixture(scope="session")
def spark():
    from pulse.session import local_session

    return local_session("8", shuffle_partitions=4)


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"

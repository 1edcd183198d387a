import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from prefdata.session import local_session

    s = local_session(cores="*", shuffle_partitions=8, app="prefdata-tests")
    yield s

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from wearline.session import local_session

    s = local_session(cpus=4, shuffle_partitions=4)
    yield s


@pytest.fixture(scope="session")
def sf_small():
    if not os.path.exists(f"{SF_SMALL}/lineitem.parquet"):
        pytest.skip("driver test data not present")
    return SF_SMALL

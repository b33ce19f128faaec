import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import local_session

    session = local_session("*", shuffle_partitions=4, memory="6g")
    session.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", "4")
    return session


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SF_DIR):
        pytest.skip("no test tables")
    return SF_DIR


def plan_of(df) -> str:
    return df._jdf.queryExecution().toString()

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from vartab.session import get_session

    s = get_session("local[*]", shuffle_partitions=8, app_name="vartab-tests")
    yield s


@pytest.fixture(scope="session")
def duck():
    from vartab.plans.compare import duckdb_connection

    return duckdb_connection(SF_SMALL)


@pytest.fixture()
def tmp_out(spark):
    from vartab.session import work_dir

    return work_dir(spark, "test")

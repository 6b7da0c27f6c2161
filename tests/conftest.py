import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from sparkcast.session import build_session

    s = build_session("local[4]", app_name="sparkcast-tests", shuffle_partitions=4)
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="sparkcast-test-ckpt-", dir="/tmp"))
    yield s


@pytest.fixture(scope="session")
def demand(spark):
    from sparkcast.sources.tables import demand_view

    return demand_view(spark, SF_SMALL).cache()


@pytest.fixture(scope="session")
def demand_pd(demand):
    return demand.toPandas().sort_values(["date", "product_id", "store_id"]).reset_index(drop=True)

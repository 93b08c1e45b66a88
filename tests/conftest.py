import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from swipeflow.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="swipeflow-warehouse-", dir="/tmp")
    s = build_session(
        app="swipeflow-tests", master="local[4]", shuffle_partitions=4,
        extra={"spark.sql.warehouse.dir": warehouse},
    )
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="swipeflow-test-", dir="/tmp")

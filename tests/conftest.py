import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from lakeloom.session import get_session

    s = get_session("local[4]", app="lakeloom-tests", shuffle_partitions=8,
                    extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="lakeloom-test-ckpt-"),
                           "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="lakeloom-test-wh-")})
    yield s
    s.stop()

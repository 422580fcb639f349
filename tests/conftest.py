import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from rxcover.session import local_session

    s = local_session(cores="*", shuffle_partitions=8,
                      extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="rxcover-test-wh-")})
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="rxcover-test-ckpt-"))
    yield s


SMALL_SF = "/root/testdata/sf0.001"
ORACLE_SF = os.environ.get("RXCOVER_ORACLE_SF", "/root/testdata/sf0.001")

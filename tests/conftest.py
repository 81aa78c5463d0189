import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from shapeloom.session import local_session
    s = local_session("*", 8, app="shapeloom-tests",
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="sl-ckpt-", dir="/tmp"),
                             # managed tables of the sink tests go to a fresh folder per run
                             "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="sl-wh-", dir="/tmp")})
    yield s
    s.stop()

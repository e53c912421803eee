import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.01"
SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import get_spark
    s = get_spark("local[8]", 8, app_name="tidemark-tests",
                  extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="tidemark-test-wh-")})
    # tests run where the cluster names no checkpoint folder: use a scratch one
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tidemark-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="tidemark-test-")

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from assetlake.session import get_session, checkpoint_dir
    s = get_session("local[4]", 8, app="assetlake-tests",
                    extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="assetlake-wh-")})
    checkpoint_dir(s)  # tests only: no cluster folder is configured
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)

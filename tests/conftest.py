import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from parcelflow.session import local_session
    s = local_session("*", app="parcelflow-tests", **{"spark.sql.shuffle.partitions": "8"})
    yield s


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="pf-test-", dir="/tmp")

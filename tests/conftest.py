import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from dockcast.session import get_spark
    s = get_spark("local[4]", 8, extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="dockcast-test-ckpt-")})
    yield s


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="dockcast-test-")

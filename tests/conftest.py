import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from quillspark.session import get_session

    ckpt = tempfile.mkdtemp(prefix="quillspark-test-ckpt-")
    s = get_session("local[4]", 8, extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def registry():
    from quillspark.plans import registry as r

    r.load_all()
    return r

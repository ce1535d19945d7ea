import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from roadlens.session import get_session
    s = get_session("local[*]", 8, extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="roadlens-test-")})
    yield s
    s.stop()

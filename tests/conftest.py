import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerhawk.config import build_session, checkpoint_dir  # noqa: E402

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", "ledgerhawk-tests", spark__sql__shuffle__partitions="8",
                      spark__driver__memory="4g")
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(s, tempfile.mkdtemp(prefix="ckpt-", dir="/tmp"))
    yield s
    s.stop()


@pytest.fixture
def scratch():
    return tempfile.mkdtemp(prefix="lh-test-", dir="/tmp")

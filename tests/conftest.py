from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from compare import SF_CHECK, duck_connect  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from skyledger.session import get_session
    s = get_session("local[*]", app="skyledger-tests", shuffle_partitions=8,
                    extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="skyledger-test-ckpt-")})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    return duck_connect(SF_CHECK)


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="skyledger-test-")

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tremor.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[4]", shuffle_partitions=8, app="tremor-tests")
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark, request):
    import re

    from tremor.session import scratch_dir

    return scratch_dir(spark, "tests", re.sub(r"[^A-Za-z0-9_.-]", "_", request.node.name))

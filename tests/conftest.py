import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TEST_SF_DIR = os.environ.get("TABKIT_TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from tabkit.session import get_session
    s = get_session(master="local[4]", shuffle_partitions=8,
                    extra={"spark.ui.showConsoleProgress": "false"})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return TEST_SF_DIR

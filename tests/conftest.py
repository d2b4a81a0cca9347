import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

from testdata_paths import SF_SMALL  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from marketpulse.session import get_session
    s = get_session("local[4]", app="marketpulse-tests", shuffle_partitions=8, driver_memory="6g")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck_small():
    from compare import duck
    return duck(SF_SMALL)

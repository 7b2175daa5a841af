import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    from landloom.runtime import local_session, ship

    s = local_session("tests", "4", **{"spark.sql.shuffle.partitions": "4"})
    ship(s)
    yield s
    s.stop()

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)



@pytest.fixture(scope="session")
def spark():
    from tessera.session import get_spark
    s = get_spark("tessera-tests", master="local[4]", shuffle_partitions=4, driver_memory="8g")
    yield s
    s.stop()

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from ledgergraph.session import get_spark
    s = get_spark("local[*]", app="ledgergraph-tests", shuffle_partitions=8, driver_memory="8g")
    yield s
    s.stop()

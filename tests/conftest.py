import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ.setdefault("PYSPARK_PYTHON", sys.executable)


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import get_spark

    s = get_spark("local[4]", shuffle_partitions=4, spark__driver__memory="4g")
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(scope="session")
def sf():
    return os.environ.get("TIDEMARK_SF", "/root/testdata/sf0.001")

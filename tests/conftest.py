import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
os.environ.setdefault("PYSPARK_PYTHON", sys.executable)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from evigraph.session import get_session

    s = get_session("tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g"})
    s.sparkContext.setLogLevel("ERROR")
    return s


@pytest.fixture(scope="session")
def small():
    if not os.path.isdir(SMALL):
        pytest.skip("no test tables here")
    return SMALL


@pytest.fixture()
def rows():
    """The rows of a DataFrame as a sorted list of tuples, columns in the order given."""

    def get(df, *cols):
        return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)

    return get

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from loanlens.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4, memory="6g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """A frame from tuples and a declared schema."""
    return lambda data, schema: spark.createDataFrame(data, schema)


@pytest.fixture(autouse=True)
def own_plans(request):
    """A test that does not ask for the persisted lending tables plans its own from the files, whichever tests ran before."""
    if "spark" in request.fixturenames and "lending" not in request.fixturenames:
        request.getfixturevalue("spark").catalog.clearCache()

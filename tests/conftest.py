import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from starloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false"
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def star_frame(spark):
    """Stars from (source_id, px_over_err, x, y, z, dist, color, abs_mag) rows."""
    from starloom import schemas

    def make(rows):
        return spark.createDataFrame(rows, schemas.STAR)

    return make

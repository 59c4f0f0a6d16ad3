import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from zonelens.session import local_session

    return local_session("tests", "8", **{"spark.sql.shuffle.partitions": "4"})


@pytest.fixture
def rows(spark):
    """Rows of literal data as a frame."""

    def make(schema, *data):
        return spark.createDataFrame(list(data), schema)

    return make

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from vectide.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 8, **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture
def vectors(spark):
    def make(rows, key="long"):
        return spark.createDataFrame(rows, f"id {key}, vector array<float>")

    return make


@pytest.fixture
def asked(spark):
    def make(rows):
        return spark.createDataFrame(rows, "qid long, qv array<float>")

    return make

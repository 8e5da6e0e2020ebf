import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from vellum.session import build_session, ship  # noqa: E402

DATA = os.environ.get("TEST_DATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    s = build_session("tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.default.parallelism": "4"})
    s.sparkContext.setLogLevel("ERROR")
    ship(s)
    return s


@pytest.fixture(scope="session")
def data():
    return DATA

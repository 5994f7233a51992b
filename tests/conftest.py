import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stationflow.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("*", 8, "tests")
    yield session
    session.stop()


@pytest.fixture
def hours(spark):
    """Build an hourly series from (station, ISO time, ridership) rows."""

    def build(rows):
        text = spark.createDataFrame(rows, "station_complex string, t string, ridership double")
        return text.selectExpr("cast(t as timestamp_ntz) as transit_timestamp", "station_complex", "ridership")

    return build

from __future__ import annotations

import pytest

from tests.session import local_session

SMALL = "/root/testdata/sf0.001"

POINT_SCHEMA = (
    "event_id bigint, file_day bigint, mmsi string, ts bigint, latitude double,"
    " longitude double, sog double, name string, navigational_status string"
)


@pytest.fixture(scope="session")
def spark():
    session = local_session(4)
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_points(spark):
    """Builds points from dicts; what a dict leaves out gets an ordinary value."""

    def build(rows):
        filled = []
        for i, row in enumerate(rows):
            usual = {
                "event_id": i,
                "file_day": 1,
                "mmsi": "219000001",
                "ts": 1000 + 10 * i,
                "latitude": 55.2,
                "longitude": 14.2,
                "sog": 8.0,
                "name": "ALPHA",
                "navigational_status": "Under way using engine",
            }
            assert set(row) <= set(usual)
            filled.append(tuple((usual | row).values()))
        return spark.createDataFrame(filled, POINT_SCHEMA)

    return build

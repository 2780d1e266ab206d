import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from eventide.session import local_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, shuffle_partitions=8)
    yield s
    s.stop()


def make_events(spark, rows):
    """rows: (id, event_type, date_event, seq) -> canonical events frame."""
    data = [(str(i), t, int(d), float(d) / 10.0, float(s), f"loc-{s}", int(s)) for i, t, d, s in rows]
    return spark.createDataFrame(
        data, "id string, event_type string, date_event long, lat double, lng double, location string, seq long"
    )

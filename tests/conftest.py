import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from staylens.session import build_session
    s = build_session("local[4]", 4, app="staylens-tests")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="staylens-test-ckpt-"))
    yield s
    s.stop()


BASE_EVENT = {
    "arrival_date": "2022-06-10",
    "departure_date": "2022-06-14",
    "length_of_stay": 4,
    "user_country": "Netherlands",
    "hotel_id": 1235,
    "hotel_name": "Canal House",
    "hotel_latitude": 40.5,
    "hotel_longitude": -73.25,
    "timestamp": "2022-01-24T09:20:00",
    "search_results": [{"room_name": "Loft", "price": 88.5, "currency": "EUR"}],
}


@pytest.fixture
def base_event():
    import copy
    return copy.deepcopy(BASE_EVENT)


def messages(spark, items):
    """Raw message frame from (request_id, received_at, body) tuples; dict bodies are JSON-encoded."""
    import datetime as dt
    import json
    rows = []
    for rid, at, body in items:
        if isinstance(at, str):
            at = dt.datetime.fromisoformat(at)
        rows.append((rid, at, body if isinstance(body, str) or body is None else json.dumps(body)))
    return spark.createDataFrame(rows, "request_id string, received_at timestamp, value string")

import os
import sys
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pulseboard.schema import EVENT_LABELS, EVENT_NUMERICS  # noqa: E402
from pulseboard.session import local_session  # noqa: E402

SF001 = "/root/testdata/sf0.01"
SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session(cpus="*", shuffle_partitions=8, app="pulseboard-tests")
    yield s


def _schema_ddl() -> str:
    cols = ["event_id bigint", "ts timestamp"] + [f"{c} string" for c in EVENT_LABELS] \
        + [f"{c} double" for c in EVENT_NUMERICS]
    return ", ".join(cols)


DEFAULT_EVENT = {
    "event_id": None, "ts": datetime(2026, 5, 13, 10, 0, 0),
    "tenant_id": "t1", "timeline_id": "tl-1", "media_content_id": "m1", "environment": "development",
}


def make_events(spark, rows: list[dict]):
    """Flat tracking events from dicts (missing fields null, context defaults above)."""
    cols = ["event_id", "ts", *EVENT_LABELS, *EVENT_NUMERICS]
    data = []
    for i, r in enumerate(rows):
        d = {**DEFAULT_EVENT, **r}
        if d["event_id"] is None:
            d["event_id"] = i
        data.append(tuple(d.get(c) for c in cols))
    return spark.createDataFrame(data, _schema_ddl())


def expand(stage: str, n: int, **fields) -> list[dict]:
    return [{"stage": stage, **fields} for _ in range(n)]


@pytest.fixture(scope="session")
def events_factory(spark):
    return lambda rows: make_events(spark, rows)

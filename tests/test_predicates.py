"""P1-P6 predicate composition (request shapes of the reference's query-shape and read-API tests)."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import make_events
from pulseboard.operators.predicates import (
    EventQuery, MetricQuery, RealtimeQuery, event_predicate, metric_predicate, realtime_predicate,
)


@pytest.fixture(scope="module")
def ev(spark):
    rows = [
        {"event_id": 1, "tenant_id": "t1", "environment": "development", "timeline_id": "a", "platform": "web",
         "ts": datetime(2026, 1, 1, 10)},
        {"event_id": 2, "tenant_id": "t1", "environment": "production", "timeline_id": "a", "platform": "web",
         "ts": datetime(2026, 1, 1, 10)},
        {"event_id": 3, "tenant_id": "t1", "environment": "development", "timeline_id": "b", "platform": "ios",
         "media_content_id": "m2", "ts": datetime(2026, 1, 1, 11)},
        {"event_id": 4, "tenant_id": "t2", "environment": "development", "timeline_id": "a", "platform": "web",
         "ts": datetime(2026, 1, 1, 12)},
        {"event_id": 5, "tenant_id": "t1", "environment": "development", "timeline_id": "a", "platform": "web",
         "ts": datetime(2026, 1, 1, 12)},
    ]
    return make_events(spark, rows)


def ids(df):
    return sorted(r["event_id"] for r in df.select("event_id").collect())


def test_minimal_query_uses_default_environment(ev):
    assert ids(ev.where(event_predicate(EventQuery(tenant_id="t1")))) == [1, 3, 5]


def test_null_environment_disables_filter(ev):
    assert ids(ev.where(event_predicate(EventQuery(tenant_id="t1", environment=None)))) == [1, 2, 3, 5]


def test_full_query(ev):
    q = EventQuery(tenant_id="t1", timeline_ids=("a", "b"), media_content_id="m1", start="2026-01-01T10:00:00Z",
                   end="2026-01-01T12:00:00Z", platform="web", environment="development")
    assert ids(ev.where(event_predicate(q))) == [1]


def test_from_only_and_to_only_are_half_open(ev):
    assert ids(ev.where(event_predicate(EventQuery(tenant_id="t1", start="2026-01-01T11:00:00Z")))) == [3, 5]
    assert ids(ev.where(event_predicate(EventQuery(tenant_id="t1", end="2026-01-01T12:00:00Z")))) == [1, 3]


def test_empty_strings_and_lists_are_absent(ev):
    q = EventQuery(tenant_id="t1", timeline_ids=(), media_content_id="", platform="", start="", end="")
    assert ids(ev.where(event_predicate(q))) == [1, 3, 5]


def test_tenant_is_mandatory():
    with pytest.raises(ValueError):
        event_predicate(EventQuery(tenant_id=""))


def test_realtime_profile_drops_match_when_timelines_given(ev):
    q = RealtimeQuery(timeline_ids=("b",), match_id="m1")
    assert ids(ev.where(realtime_predicate(q, "t1"))) == [3]
    assert ids(ev.where(realtime_predicate(RealtimeQuery(match_id="m1"), "t1"))) == [1, 2, 5]
    assert ids(ev.where(realtime_predicate(RealtimeQuery(question_id="a"), "t1"))) == [1, 2, 5]
    assert RealtimeQuery(question_id="a").context_timeline() == "a"
    assert RealtimeQuery().context_timeline() == ""


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(
        [("t1", "m1", "a", datetime(2026, 1, 1)), ("t1", "m1", "b", datetime(2026, 1, 2)),
         ("t1", "m2", "a", datetime(2026, 1, 3)), ("t2", "m1", "a", datetime(2026, 1, 2))],
        "tenantId string, matchId string, timelineId string, intervalFrom timestamp")


def test_metric_filter_closed_range(table):
    q = MetricQuery(tenant_id="t1", start="2026-01-01T00:00:00Z", end="2026-01-02T00:00:00Z")
    assert table.where(metric_predicate(q)).count() == 2


def test_metric_filter_match_and_timelines(table):
    assert table.where(metric_predicate(MetricQuery(tenant_id="t1", match_id="m1"))).count() == 2
    assert table.where(metric_predicate(MetricQuery(tenant_id="t1", timeline_ids=("a",)))).count() == 2
    assert table.where(metric_predicate(MetricQuery(tenant_id="t1"))).count() == 3

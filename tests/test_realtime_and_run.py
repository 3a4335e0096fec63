"""Realtime views (A12-A14, A17), all-metrics run with error isolation (A18), properties."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import SF001, expand, make_events
from pulseboard.operators import metrics as M
from pulseboard.operators.context import grid_context
from pulseboard.operators.predicates import RealtimeQuery
from pulseboard.operators.realtime import Realtime
from pulseboard.plans import etl as ETL
from pulseboard.session import ensure_checkpoint_dir
from pulseboard.sources.events import fixture_events

NOW = "2026-06-01T00:00:00Z"


def test_funnel_sums_platforms_and_zero_row_when_empty(spark):
    rows = (expand("sent", 2, platform="web", room_size=50.0) + expand("received", 90, platform="web")
            + expand("rendered", 80, platform="ios") + expand("render-failed", 3, platform=None)
            + expand("received", 5, platform="ios", environment="production"))
    ev = make_events(spark, rows)
    f = Realtime(ev, RealtimeQuery(), "t1", NOW).funnel().collect()[0]
    assert (f["sent"], f["received"], f["rendered"], f["failed"]) == (100.0, 95, 80, 3)
    assert (f["receiveRate"], f["renderRate"], f["failureRate"], f["netSuccessRate"]) == (95.0, 84.21, 3.16, 80.0)
    empty = Realtime(ev, RealtimeQuery(timeline_ids=("nothing",)), "t1", NOW).funnel().collect()
    assert len(empty) == 1 and empty[0]["sent"] == 0.0 and empty[0]["receiveRate"] == 0.0
    lat = Realtime(ev, RealtimeQuery(timeline_ids=("nothing",)), "t1", NOW).latency().collect()
    assert len(lat) == 1 and lat[0]["receive_p50"] == 0.0 and lat[0]["intervalFrom"] == datetime(1970, 1, 1)


def test_realtime_needs_now_without_to(spark):
    with pytest.raises(ValueError):
        Realtime(make_events(spark, [{"stage": "sent"}]), RealtimeQuery(), "t1", None)


def test_property_platform_rows_sum_to_funnel(spark):
    ev = fixture_events(spark, SF001)
    rt = Realtime(ev, RealtimeQuery(start="2024-01-01T00:00:00Z", end="2024-02-01T00:00:00Z"), None)
    heat = rt.heatmap().groupBy("tenantId").agg(F.sum("received").alias("r"), F.sum("failed").alias("f"))
    fun = rt.funnel().select("tenantId", F.col("received").alias("r"), F.col("failed").alias("f"))
    assert sorted(heat.collect()) == sorted(fun.collect())


def test_property_failure_shares_sum_to_100(spark):
    base = grid_context(fixture_events(spark, SF001), 1440, environment="development")
    sums = M.failure_analysis(base).groupBy("tenantId", "matchId", "timelineId", "intervalFrom") \
        .agg(F.sum("percentOfFailed").alias("s")).collect()
    assert sums and all(abs(r["s"] - 100.0) <= 0.05 for r in sums)


def test_property_event_outside_interval_changes_nothing(spark):
    rows = [{"stage": "received", "ts": datetime(2026, 5, 13, 10, 5)}]
    a = M.platform_metrics(grid_context(make_events(spark, rows), 60, environment="development")).collect()
    b = M.platform_metrics(grid_context(make_events(spark, rows + [{"stage": "received",
                                                                     "ts": datetime(2026, 5, 13, 11, 0)}]), 60, environment="development")) \
        .where(F.col("intervalFrom") == datetime(2026, 5, 13, 10)).collect()
    assert a == b


def test_all_metrics_isolate_failures(spark, tmp_path):
    ensure_checkpoint_dir(spark)
    base = grid_context(make_events(spark, expand("received", 3, platform="web")), 60, environment="development")

    def boom(_):
        raise RuntimeError("broken metric")

    registry = {**M.METRIC_FUNCTIONS, "device": boom}
    with pytest.raises(ETL.MetricRunError) as err:
        ETL.run_all(spark, base, str(tmp_path), registry=registry)
    assert set(err.value.failures) == {"device"} and "device" in str(err.value)
    assert spark.read.parquet(str(tmp_path / "platform")).count() == 1
    assert spark.read.parquet(str(tmp_path / "latency")).count() == 1


def test_all_metrics_rerun_is_idempotent(spark, tmp_path):
    ensure_checkpoint_dir(spark)
    base = grid_context(make_events(spark, expand("received", 3, platform="web") + expand("sent", 1, room_size=4.0)), 60, environment="development")
    for _ in range(2):
        ETL.run_all(spark, base, str(tmp_path))
    p = spark.read.parquet(str(tmp_path / "platform")).collect()
    assert len(p) == 2 and sum(r["received"] for r in p) == 3


def test_forced_percentiles_keep_the_zero_row_of_an_empty_request(spark):
    ev = make_events(spark, expand("received", 2, receive_latency_ms=5.0))
    rt = Realtime(ev, RealtimeQuery(timeline_ids=("nothing",)), "t1", NOW)
    got = rt.latency().collect()
    assert len(got) == 1 and got[0]["receive_p99"] == 0.0


def test_failed_metrics_send_the_jobs_to_the_dead_letters(spark, tmp_path, monkeypatch):
    import json

    from pulseboard.streaming.consumer import job_consumer_sink
    ensure_checkpoint_dir(spark)

    def broken(*_a, **_k):
        raise ETL.MetricRunError({"device": "RuntimeError: broken metric"})

    monkeypatch.setattr(ETL, "run_all", broken)
    good = json.dumps({"version": 1, "jobType": "process-timeline", "tenantId": "t1", "matchId": "m1", "timelineId": "tl-1",
                       "timeRangeMinutes": 60, "retryCount": 0, "origin": "scheduled"})
    batch = spark.createDataFrame([(good,), ("not json",)], "value string")
    from pulseboard.plans import jobs as JB
    ok = JB.validate_jobs(batch).where("is_valid").count()
    sink = job_consumer_sink(make_events(spark, expand("received", 1)), str(tmp_path / "store"), str(tmp_path / "dlq"),
                             lambda _: NOW, environment=None)
    for _ in range(2):  # a replay rewrites its own letters
        sink(batch, 0)
    letters = {r["value"]: r["errorMessage"] for r in spark.read.parquet(str(tmp_path / "dlq")).collect()}
    assert ok == 1 and set(letters) == {good, "not json"} and "broken metric" in letters[good]

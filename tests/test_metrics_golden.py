"""Golden cases of the reference's use-case tests, expanded to raw events."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import expand, make_events
from pulseboard.operators import metrics as M
from pulseboard.operators.context import grid_context
from pulseboard.plans import jobs as JB


def base_of(spark, rows, minutes=60):
    return grid_context(make_events(spark, rows), minutes, environment="development")


def by(rows, key):
    return {r[key]: r.asDict() for r in rows}


def platform_rows(platform, sent, received, rendered, failed, avg=None):
    rows = []
    if sent:
        rows += expand("sent", 10, platform=platform, room_size=sent / 10)
    rows += expand("received", received, platform=platform)
    rows += expand("rendered", rendered, platform=platform, render_duration_ms=avg)
    rows += expand("render-failed", failed, platform=platform)
    return rows


def test_platform_golden(spark):
    rows = (platform_rows("web", 1000, 950, 900, 50, 120.456) + platform_rows("ios", 500, 450, 405, 45, 98.1)
            + platform_rows("android", 200, 180, 160, 20, 80.0) + platform_rows(None, 50, 40, 35, 5, 77.0))
    out = by(M.platform_metrics(base_of(spark, rows)).collect(), "platform")
    w, i, a, u = out["web"], out["ios"], out["android"], out["unknown"]
    assert (w["sent"], w["received"], w["rendered"], w["failed"]) == (1000.0, 950, 900, 50)
    assert (w["receiveRate"], w["renderRate"], w["failureRate"], w["netSuccessRate"], w["avgRenderMs"]) == \
        (95.0, 94.74, 5.26, 90.0, 120.46)
    assert (i["receiveRate"], i["renderRate"], i["failureRate"], i["netSuccessRate"], i["avgRenderMs"]) == \
        (90.0, 90.0, 10.0, 81.0, 98.1)
    assert (a["receiveRate"], a["renderRate"], a["failureRate"], a["netSuccessRate"], a["avgRenderMs"]) == \
        (90.0, 88.89, 11.11, 80.0, 80.0)
    assert (u["receiveRate"], u["renderRate"], u["failureRate"], u["netSuccessRate"], u["avgRenderMs"]) == \
        (80.0, 87.5, 12.5, 70.0, 77.0)
    assert w["intervalFrom"] == datetime(2026, 5, 13, 10) and w["intervalTo"] == datetime(2026, 5, 13, 11)


def test_platform_zero_sent_and_rates_above_100(spark):
    rows = platform_rows("web", 0, 10, 11, 2) + platform_rows("ios", 100, 110, 120, 11)
    out = by(M.platform_metrics(base_of(spark, rows)).collect(), "platform")
    w, i = out["web"], out["ios"]
    assert (w["sent"], w["receiveRate"], w["renderRate"], w["failureRate"], w["netSuccessRate"], w["avgRenderMs"]) \
        == (0.0, 0.0, 110.0, 20.0, 0.0, 0.0)
    assert (i["receiveRate"], i["renderRate"], i["failureRate"], i["netSuccessRate"], i["avgRenderMs"]) == \
        (110.0, 109.09, 10.0, 120.0, 0.0)


def test_platform_filters_sent_and_avg_by_stage(spark):
    # room_size on a non-sent row and render time on a failed row do not count in A3
    rows = [{"stage": "sent", "room_size": 10.0, "platform": "web"},
            {"stage": "received", "room_size": 99.0, "platform": "web"},
            {"stage": "rendered", "render_duration_ms": 10.0, "platform": "web"},
            {"stage": "render-failed", "render_duration_ms": 1000.0, "platform": "web"}]
    r = M.platform_metrics(base_of(spark, rows)).collect()[0]
    assert r["sent"] == 10.0 and r["avgRenderMs"] == 10.0


def test_empty_key_and_null_key_are_one_bucket(spark):
    rows = [{"stage": "received", "platform": ""}, {"stage": "received", "platform": None}]
    out = M.platform_metrics(base_of(spark, rows)).collect()
    assert len(out) == 1 and out[0]["platform"] == "unknown" and out[0]["received"] == 2


def test_top_n_truncation_orders_by_count_then_key(spark):
    rows = (expand("received", 3, platform="c") + expand("received", 3, platform="b")
            + expand("received", 2, platform="a") + expand("received", 5, platform="d"))
    out = [r["platform"] for r in M.platform_metrics(base_of(spark, rows), top_n=2).collect()]
    assert sorted(out) == ["b", "d"]


def test_device_golden_and_fallback(spark):
    rows = (expand("received", 120, browser="Chrome") + expand("rendered", 90, browser="Chrome",
                                                               render_duration_ms=81.234)
            + expand("render-failed", 6, browser="Chrome") + expand("received", 80, browser="Firefox")
            + expand("rendered", 64, browser="Firefox", render_duration_ms=95.0)
            + expand("render-failed", 4, browser="Firefox"))
    out = M.device_breakdown(base_of(spark, rows), ["browser", "unsupported-dimension"]).collect()
    d = {(r["dimension"], r["bucketKey"]): r for r in out}
    c = d[("browser", "Chrome")]
    assert (c["received"], c["rendered"], c["failed"], c["renderRate"], c["avgRenderMs"]) == (120, 90, 6, 75.0, 81.23)
    f = d[("browser", "Firefox")]
    assert (f["renderRate"], f["avgRenderMs"]) == (80.0, 95.0)
    # unknown dimension names read the browser label
    assert d[("unsupported-dimension", "Chrome")]["received"] == 120


def test_device_three_dimensions_one_pass(spark):
    rows = [{"stage": "received", "browser": "Chrome", "client_os": None, "device_class": "Mobile"}]
    out = sorted((r["dimension"], r["bucketKey"]) for r in M.device_breakdown(base_of(spark, rows)).collect())
    assert out == [("browser", "Chrome"), ("deviceClass", "Mobile"), ("os", "unknown")]


def test_transport_golden(spark):
    rows = (expand("received", 120, transport_mode="websocket")
            + expand("rendered", 108, transport_mode="websocket", render_duration_ms=42.456)
            + expand("ack", 0, transport_mode="websocket"))
    vals = [float(v) for v in range(1, 101)]
    rows += [{"stage": "rendered", "transport_mode": "http", "render_duration_ms": v} for v in vals]
    rows += expand("received", 100, transport_mode="http") + expand("sent", 7, transport_mode="http")
    out = by(M.transport_comparison(base_of(spark, rows)).collect(), "transportMode")
    ws = out["websocket"]
    assert (ws["count"], ws["renderRate"], ws["avgRenderMs"], ws["p95RenderMs"]) == (228, 90.0, 42.46, 42.46)
    h = out["http"]
    # count covers every stage; p95 interpolates linearly: 1 + 0.95 * 99 = 95.05
    assert h["count"] == 207 and h["p95RenderMs"] == 95.05 and h["renderRate"] == 100.0


def test_transport_rates_above_32_bits(spark):
    # derivation over counts beyond 2^31 (checked on the expressions, not on 4.5e9 rows)
    from pulseboard.functions import rate
    df = spark.createDataFrame([(4_500_000_000, 3_000_000_000, 1_500_000_000)], "c long, rec long, ren long")
    r = df.select("c", rate("ren", "rec").alias("rr")).collect()[0]
    assert r["c"] == 4_500_000_000 and r["rr"] == 50.0


def test_sdk_golden_and_empty_key(spark):
    rows = (expand("received", 100, sdk_version="1.0.0") + expand("rendered", 90, sdk_version="1.0.0",
                                                                  render_duration_ms=110.123)
            + expand("received", 10, sdk_version=""))
    out = by(M.sdk_versions(base_of(spark, rows)).collect(), "sdkVersion")
    assert (out["1.0.0"]["count"], out["1.0.0"]["renderRate"], out["1.0.0"]["avgRenderMs"]) == (190, 90.0, 110.12)
    u = out["unknown"]
    assert (u["count"], u["renderRate"], u["avgRenderMs"]) == (10, 0.0, 0.0)


def test_failure_golden(spark):
    spec = {("timeout", "load"): 20, ("timeout", "render"): 10, ("network", "load"): 15, ("network", "render"): 10,
            ("network", "ack"): 5, ("validation", "schema"): 8, ("validation", "load"): 2}
    rows = []
    for (reason, step), n in spec.items():
        rows += expand("render-failed", n, failure_reason=reason, failure_step=step)
    rows += expand("rendered", 3, failure_reason=None, failure_step="load")   # no reason -> no row
    out = {(r["failureReason"], r["failureStep"]): r["percentOfFailed"]
           for r in M.failure_analysis(base_of(spark, rows)).collect()}
    assert out == {("timeout", "load"): 28.57, ("timeout", "render"): 14.29, ("network", "load"): 21.43,
                   ("network", "render"): 14.29, ("network", "ack"): 7.14, ("validation", "schema"): 11.43,
                   ("validation", "load"): 2.86}


def test_failure_nested_topk_counts_stepless_rows_for_reason_rank(spark):
    rows = (expand("render-failed", 5, failure_reason="a", failure_step=None)
            + expand("render-failed", 1, failure_reason="a", failure_step="x")
            + expand("render-failed", 3, failure_reason="b", failure_step="y"))
    out = M.failure_analysis(base_of(spark, rows), top_reasons=1).collect()
    # reason a (6 rows, 5 without step) outranks b (3 rows); only its step row is emitted
    assert [(r["failureReason"], r["failureStep"], r["count"], r["percentOfFailed"]) for r in out] == \
        [("a", "x", 1, 100.0)]


def test_latency_golden_and_zero_fill(spark):
    rows = ([{"stage": "received", "receive_latency_ms": v} for v in (10.0, 18.456 * 2 - 10.0)]
            + [{"stage": "rendered", "render_duration_ms": 66.666}]
            + [{"stage": "ack", "ack_latency_ms": 3.333}])
    base = base_of(spark, rows)
    flat = M.latency_percentiles(base).collect()[0]
    assert (flat["receive_avg"], flat["receive_max"]) == (18.46, 26.91)
    assert flat["render_avg"] == 66.67 and flat["ack_p99"] == 3.33
    assert flat["renderDuration_p95"] == flat["render_p95"] and flat["renderDuration_avg"] == flat["render_avg"]
    jobs = spark.createDataFrame(
        [("t1", "m1", "tl-1", datetime(2026, 5, 13, 10), datetime(2026, 5, 13, 11)),
         ("t1", "m1", "tl-9", datetime(2026, 5, 13, 10), datetime(2026, 5, 13, 11))],
        "tenantId string, matchId string, timelineId string, intervalFrom timestamp, intervalTo timestamp")
    zf = {r["timelineId"]: r for r in JB.zero_fill_latency(jobs, M.latency_percentiles(base)).collect()}
    assert len(zf) == 2 and all(v == 0.0 for k, v in zf["tl-9"].asDict().items() if k.startswith(("receive", "ack")))
    assert zf["tl-1"]["receive_avg"] == 18.46


def test_empty_window_only_latency_row(spark):
    ev = make_events(spark, [{"stage": "received", "ts": datetime(2026, 1, 1)}])
    jobs = spark.createDataFrame([("t1", "m1", "tl-1", datetime(2026, 5, 13, 10), datetime(2026, 5, 13, 11))],
                                 "tenantId string, matchId string, timelineId string, intervalFrom timestamp, "
                                 "intervalTo timestamp")
    base = JB.jobs_join_events(jobs, ev, environment="development")
    assert M.platform_metrics(base).count() == 0 and M.timeseries(base).count() == 0
    lat = JB.zero_fill_latency(jobs, M.latency_percentiles(base)).collect()
    assert len(lat) == 1 and lat[0]["render_p50"] == 0.0


def test_timeseries_golden(spark):
    start = datetime(2026, 5, 13, 10, 0)
    rows = []
    for i in range(10):
        t = start + timedelta(minutes=5 * i, seconds=30)
        rows += [{"stage": "rendered", "ts": t, "render_duration_ms": 30.123 + i, "room_size": None}]
    ts = M.timeseries(base_of(spark, rows), ["avgRenderMs"]).orderBy("time").collect()
    assert len(ts) == 10 and ts[0]["value"] == 30.12 and ts[-1]["value"] == 39.12
    assert ts[-1]["time"] == datetime(2026, 5, 13, 10, 45)


def test_timeseries_gap_fill_any_stage_span(spark):
    rows = [{"stage": "received", "ts": datetime(2026, 5, 13, 10, 1)},
            {"stage": "ack", "ts": datetime(2026, 5, 13, 10, 21), "room_size": 5.0}]
    out = {(r["metric"], r["time"].minute): r["value"] for r in M.timeseries(base_of(spark, rows)).collect()}
    # 10:00 .. 10:20 -> 5 buckets, gaps are zero; sent has no stage filter in the timeseries
    assert out[("received", 0)] == 1.0 and out[("received", 10)] == 0.0 and out[("sent", 20)] == 5.0
    assert len({m for m, _ in out}) == 5 and len(out) == 25


def test_timeseries_rejects_unknown_metric(spark):
    with pytest.raises(ValueError, match="invalidMetric is no timeseries metric"):
        M.timeseries(base_of(spark, [{"stage": "sent"}]), ["invalidMetric"])


def test_half_open_interval(spark):
    rows = [{"stage": "received", "ts": datetime(2026, 5, 13, 10, 0)},
            {"stage": "received", "ts": datetime(2026, 5, 13, 11, 0)}]
    out = M.platform_metrics(base_of(spark, rows)).where(F.col("intervalFrom") == datetime(2026, 5, 13, 10)).collect()
    assert out[0]["received"] == 1


def test_sdk_derivations_on_bucket_values(spark):
    """Bucket values of the reference's five-version case; the derivations applied directly."""
    from pulseboard.functions import r2, rate
    buckets = [("1.0.0", 100, 100, 90, 110.123), ("1.1.0", 200, 160, 120, 95.5), ("2.0.0", 300, 300, 210, 80.0),
               ("2.1.0", 400, 250, 200, 70.777), ("3.0.0", 500, 500, 400, 65.0)]
    df = spark.createDataFrame(buckets, "k string, c long, rec long, ren long, avg double")
    out = df.select("k", rate("ren", "rec").alias("rr"), r2("avg").alias("a")).orderBy("k").collect()
    assert [r["rr"] for r in out] == [90.0, 75.0, 70.0, 80.0, 80.0]
    assert [r["a"] for r in out] == [110.12, 95.5, 80.0, 70.78, 65.0]

"""S1/S2 nested event files, P9 key guard, ST2 late data beyond the watermark."""

import json
import os
from datetime import datetime

import pytest

from conftest import make_events
from pulseboard.operators import metrics as M
from pulseboard.operators.context import grid_context
from pulseboard.plans import store as ST
from pulseboard.session import ensure_checkpoint_dir
from pulseboard.sources.events import flatten_events, read_tracking_events
from pulseboard.streaming import windowed as SW


def _doc(ts, stage, platform="web", **num):
    return {"@timestamp": ts, "labels": {"tenant_id": "t1", "timeline_id": "tl-1", "media_content_id": "m1",
                                         "environment": "development", "stage": stage, "platform": platform},
            "numeric_labels": num}


def test_nested_json_events_flatten_and_aggregate(spark, tmp_path):
    docs = [_doc("2026-05-13T10:01:00Z", "sent", room_size=40), _doc("2026-05-13T10:02:00Z", "received"),
            _doc("2026-05-13T10:03:00Z", "rendered", render_duration_ms=12.5),
            _doc("2026-05-13T10:03:00Z", "rendered", "ios", render_duration_ms=7.25)]
    d = tmp_path / "tracking-events-2026.05.13"
    d.mkdir()
    (d / "part-0.json").write_text("\n".join(json.dumps(x) for x in docs))
    ev = flatten_events(read_tracking_events(spark, str(tmp_path / "tracking-events-*"), "json"))
    out = {r["platform"]: r for r in M.platform_metrics(grid_context(ev, 60, environment="development")).collect()}
    assert out["web"]["sent"] == 40.0 and out["web"]["receiveRate"] == 2.5 and out["web"]["avgRenderMs"] == 12.5
    assert out["ios"]["rendered"] == 1 and out["web"]["intervalFrom"] == datetime(2026, 5, 13, 10)


def test_upsert_rejects_rows_without_unique_fields(spark, tmp_path):
    ensure_checkpoint_dir(spark)
    rows = M.platform_metrics(grid_context(make_events(spark, [{"stage": "received"}]), 60, environment="development"))
    bad = rows.withColumn("matchId", rows["matchId"].substr(1, 0).cast("string")).na.replace("", None, ["matchId"])
    with pytest.raises(Exception, match="Missing unique field"):
        ST.upsert_table(spark, str(tmp_path / "p"), bad, "platform")


def test_late_event_beyond_watermark_is_left_to_backfill(spark, tmp_path):
    src = tmp_path / "events"
    src.mkdir()
    schema = ("event_id bigint, ts timestamp, timeline_id string, tenant_id string, media_content_id string, "
              "environment string, stage string, platform string, browser string, client_os string, "
              "device_class string, transport_mode string, sdk_version string, failure_reason string, "
              "failure_step string, room_size double, render_duration_ms double, receive_latency_ms double, "
              "ack_latency_ms double")
    first = make_events(spark, [{"stage": "received", "ts": datetime(2026, 5, 13, 12, 30)}])
    late = make_events(spark, [{"stage": "received", "ts": datetime(2026, 5, 13, 10, 30)},
                               {"stage": "received", "ts": datetime(2026, 5, 13, 12, 40)}])
    first.write.parquet(str(src / "b1"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(src / "*"))
    out = SW.stream_platform_metrics(stream, minutes=60, watermark="10 minutes", environment="development")
    q = (out.writeStream.outputMode("update").format("memory").queryName("late_test")
         .option("checkpointLocation", str(tmp_path / "ck")).start())
    q.processAllAvailable()
    late.write.parquet(str(src / "b2"))
    q.processAllAvailable()
    q.stop()
    got = {(r["intervalFrom"].hour, r["received"]) for r in spark.sql("SELECT * FROM late_test").collect()}
    # the 10:30 event is > 10 minutes behind the max event time seen (12:30): dropped by the stream
    assert (10, 1) not in got and (12, 2) in got
    assert os.path.isdir(str(tmp_path / "ck"))

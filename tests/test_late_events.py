"""Repeated and late events of a stream become what a batch run gives; the sinks' ledger stays small."""

from datetime import datetime, timedelta

import pytest

from conftest import make_events
from pulseboard.operators import metrics as M
from pulseboard.operators.context import grid_context
from pulseboard.plans import etl as ETL
from pulseboard.sources.events import FLAT_SCHEMA
from pulseboard.streaming import late as LT
from pulseboard.streaming import sinks as SK
from pulseboard.streaming import windowed as SW
from pulseboard.streaming.ledger import Ledger

T0 = datetime(2026, 5, 13, 10)
NOW = "2026-05-14T00:00:00Z"


def at(minutes, event_id, **more):
    return {"stage": "received", "ts": T0 + timedelta(minutes=minutes), "event_id": event_id, "platform": "web", **more}


DELIVERIES = [
    [at(1, 1), at(2, 2), at(2, 2), at(130, 3), at(131, 4, environment="production")],
    [at(128, 5), at(130, 3), at(200, 6), {**at(200, 0), "event_id": -1}, {**at(200, 0), "event_id": -1}],  # -1: no id
    [at(5, 7), at(70, 8, timeline_id="tl-2"), at(201, 9), at(5, 10, environment="production")],
]


def frame(spark, rows):
    return make_events(spark, rows).selectExpr("nullif(event_id, -1) AS event_id", "* EXCEPT (event_id)")


def counts(df):
    return {(r["timelineId"], r["intervalFrom"].hour): r["received"] for r in df.collect()}


@pytest.mark.parametrize("reads_ahead", [False, True])
def test_late_and_repeated_events_end_as_in_a_batch(spark, tmp_path, reads_ahead):
    root = str(tmp_path)
    for n, rows in enumerate(DELIVERIES):
        frame(spark, rows).coalesce(1).write.parquet(f"{root}/events/delivery={n}")
        stream = spark.readStream.schema(FLAT_SCHEMA).parquet(f"{root}/events/*")
        metrics = SW.stream_platform_metrics(LT.drop_repeats(stream), environment="development", watermark=None)
        SK.run_available_now(metrics, SK.metric_upsert_sink(f"{root}/store/platform", "platform"), f"{root}/ck1")
        SK.run_available_now(stream, LT.late_event_sink(f"{root}/requests", environment="development", reads_ahead=reads_ahead),
                             f"{root}/ck2", output_mode="append")
    streamed = counts(spark.read.parquet(f"{root}/store/platform_contrib"))
    assert streamed[("tl-1", 10)] == 2 and ("tl-2", 11) not in streamed  # repeats dropped, late events missed
    requests = LT.late_requests(spark, f"{root}/requests")
    named = {(r["timelineIds"][0], r["intervalFrom"][:13]) for r in requests.collect()}
    missed = {("tl-1", "2026-05-13T10"), ("tl-2", "2026-05-13T11")}
    assert missed <= named if reads_ahead else named == missed
    archive = LT.drop_repeats(spark.read.schema(FLAT_SCHEMA).parquet(f"{root}/events/*"))
    ETL.backfill(spark, archive, requests, f"{root}/store", environment="development", now=NOW,
                 registry={"platform": M.platform_metrics})
    want = counts(M.platform_metrics(grid_context(archive, 60, environment="development")))
    assert counts(spark.read.parquet(f"{root}/store/platform_contrib")) == want
    assert want == {("tl-1", 10): 3, ("tl-1", 12): 2, ("tl-1", 13): 4, ("tl-2", 11): 1}


def test_a_repeated_batch_names_the_same_requests(spark, tmp_path):
    path = str(tmp_path / "requests")
    sink = LT.late_event_sink(path, environment=None, reads_ahead=False)
    assert LT.late_requests(spark, path).count() == 0
    sink(frame(spark, DELIVERIES[0]), 0)
    for _ in range(2):
        sink(frame(spark, DELIVERIES[2]), 1)
        assert LT.late_requests(spark, path).count() == 2
    sink(frame(spark, []), 2)  # an empty batch keeps the mark
    sink(frame(spark, [at(0, 20, timeline_id="tl-9")]), 3)
    assert LT.late_requests(spark, path).count() == 3


def test_ledger_keeps_two_rows(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "t"))
    assert ledger.last() is None and ledger.mark_before(0) is None
    for n in range(5):
        ledger.commit(n, n * 10 if n != 3 else None)
    assert ledger.last() == 4 and ledger.mark_before(4) is None and ledger.mark_before(5) == 40
    assert len(list((tmp_path / "t_ledger").rglob("*.parquet"))) == 2

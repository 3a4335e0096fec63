"""Results stay whole: no default bucket limit, extreme numbers, tenant ids as text, reruns with a vanished job."""

import pytest
from conftest import expand
from pyspark.sql import functions as F

from pulseboard.operators import latency_merge as LM
from pulseboard.operators import metrics as M
from pulseboard.operators.context import grid_context, match_level
from pulseboard.operators.match_funnel import match_funnel
from pulseboard.operators.predicates import RealtimeQuery
from pulseboard.operators.realtime import Realtime
from pulseboard.plans import store as ST

NOW = "2026-05-13T12:00:00Z"


def test_more_platforms_than_a_terms_bucket_holds(events_factory):
    ev = events_factory([{"stage": "sent", "platform": f"p{i}", "room_size": 1.0} for i in range(130)])
    assert Realtime(ev, RealtimeQuery(), "t1", now=NOW).funnel().first()["sent"] == 130
    base = grid_context(ev, 60, environment="development")
    assert M.platform_metrics(base).count() == 130
    assert M.platform_metrics(base, top_n=100).count() == 100


def test_more_questions_than_a_terms_bucket_holds(events_factory):
    ev = events_factory([{"stage": "sent", "timeline_id": f"q{i}", "room_size": 1.0} for i in range(520)])
    assert match_funnel(ev).first()["questionCount"] == 520


def test_numbers_at_the_edges(events_factory):
    nan, inf = float("nan"), float("inf")
    ev = events_factory([{"stage": "sent", "platform": "a", "room_size": x} for x in (9007199254740991.0, nan, inf, -inf, None, 1e300)]
                        + [{"stage": "rendered", "platform": "a", "render_duration_ms": x} for x in (100.0, nan, inf)])
    row = M.platform_metrics(grid_context(ev, 60, environment="development")).first()
    assert row["sent"] == 9007199254740991.0 and row["avgRenderMs"] == 100.0


def test_tenant_ids_stay_text(spark, events_factory, tmp_path):
    ev = events_factory([{"stage": "sent", "tenant_id": t, "platform": "a", "room_size": 1.0} for t in ("0012", "12")])
    ST.upsert_table(spark, str(tmp_path / "p"), M.platform_metrics(grid_context(ev, 60, environment="development")), "platform", now=NOW)
    got = ST.read_table(spark, str(tmp_path / "p"))
    assert sorted(r["tenantId"] for r in got.collect()) == ["0012", "12"]
    assert all(r["createdAt"] is not None for r in got.collect())


def test_rerun_clears_a_job_without_events(spark, events_factory, tmp_path):
    a, b = expand("sent", 5, timeline_id="a", platform="x", room_size=1.0), expand("sent", 7, timeline_id="b", platform="x", room_size=1.0)
    path, rows = str(tmp_path / "p"), lambda r: M.platform_metrics(grid_context(events_factory(r), 60, environment="development"))
    jobs = rows(a + b).select("tenantId", "matchId", "timelineId", "intervalFrom", "intervalTo")
    ST.upsert_table(spark, path, rows(a + b), "platform", now=NOW, jobs=jobs)
    ST.upsert_table(spark, path, rows(a), "platform", now=NOW, jobs=jobs)
    assert [r["sent"] for r in ST.read_table(spark, path).collect()] == [5.0]
    with pytest.raises(ValueError, match="intervalTo"):
        ST.upsert_table(spark, path, rows(a), "platform", now=NOW, jobs=jobs.drop("intervalTo"))


def test_gaps_of_any_length(events_factory):
    from datetime import datetime
    ev = events_factory([{"stage": "received", "ts": datetime(2025, 1, 1)}, {"stage": "received", "ts": datetime(2025, 12, 31, 23, 59)}])
    year = grid_context(ev, 60 * 24 * 366, environment="development").withColumns({"intervalFrom": F.lit(datetime(2025, 1, 1)), "intervalTo": F.lit(datetime(2026, 1, 1))})
    got = M.timeseries(year, ["received"], "1s").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("time").alias("d"), F.sum("value").alias("s"), F.max("time").alias("t")).first()
    n = (datetime(2025, 12, 31, 23, 59) - datetime(2025, 1, 1)).total_seconds() + 1  # 31 million buckets between two events
    assert (got["n"], got["d"], got["s"], got["t"]) == (n, n, 2.0, datetime(2025, 12, 31, 23, 59))
    day = events_factory([{"stage": "sent", "room_size": 1.0, "ts": datetime(2025, 1, 1, 0, 0, s)} for s in (0, 50)])
    assert M.timeseries(grid_context(day, 60, environment="development"), ["sent"], "1ms").count() == 50_001


def test_many_reasons_of_one_job(events_factory):
    ev = events_factory([{"stage": "render-failed", "failure_reason": f"r{i % 700:03d}", "failure_step": f"s{i % 3}"} for i in range(2100)]
                        + [{"stage": "render-failed", "failure_reason": "r000", "failure_step": None}] * 5)
    base = grid_context(ev, 60, environment="development")
    rows = M.failure_analysis(base).collect()
    assert len(rows) == 2100 and abs(sum(r["percentOfFailed"] for r in rows) - 2100 * 0.05) < 1e-6
    top = M.failure_analysis(base, top_reasons=2, top_steps=1).collect()
    assert sorted((r["failureReason"], r["count"], r["percentOfFailed"]) for r in top) == [("r000", 1, 50.0), ("r001", 1, 50.0)]


def test_debug_views_name_their_predicate(events_factory):
    q = RealtimeQuery(timeline_ids=("a", "b'c"), match_id="m", start="2026-05-13T00:00:00Z", platform="web")
    rt = Realtime(events_factory(expand("received", 1, timeline_id="a", platform="web")), q, "t1", now=NOW)
    want = "tenant_id = 't1' AND timeline_id IN ('a', 'b\\'c') AND ts >= '2026-05-13T00:00:00.000000Z' AND platform = 'web'"
    assert rt.latency_debug().first()["predicate"] == rt.funnel_debug().first()["predicate"] == want


def test_match_latency_from_stored_histograms(spark, events_factory, tmp_path):
    import random
    rnd = random.Random(5)
    rows = [{"stage": "received", "timeline_id": f"t{i % 4}", "receive_latency_ms": rnd.expovariate(0.01), "render_duration_ms": rnd.gauss(0, 50)} for i in range(2000)]
    base = grid_context(events_factory(rows + [{"stage": "received", "timeline_id": "t9"}]), 60, environment="development")
    LM.latency_histograms(base).write.parquet(str(tmp_path / "h"))
    stored = spark.read.parquet(str(tmp_path / "h"))
    got, again = LM.merge_latency(stored).first(), LM.merge_latency(stored.repartition(7)).first()
    exact = M.latency_percentiles(match_level(base)).first()
    assert got == again  # whatever the order of merging
    for s in ("receive", "render", "ack"):
        assert got[f"{s}_avg"] == exact[f"{s}_avg"] and got[f"{s}_max"] == exact[f"{s}_max"]
        for p in (50, 75, 95, 99):
            assert abs(got[f"{s}_p{p}"] - exact[f"{s}_p{p}"]) <= LM.ERROR * (abs(exact[f"{s}_p{p}"]) + 1) + 0.01

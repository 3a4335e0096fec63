"""Job messages, validation, alignment, expansion and the jobs x events join."""

from datetime import datetime

from pyspark.sql import functions as F

from conftest import make_events
from pulseboard.plans import jobs as JB
from pulseboard.sources import jobs as JS

NOW = "2026-05-13T10:30:00Z"


def msgs(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_payload_validation(spark):
    values = [
        '{"tenantId":"t","matchId":"m","timelineId":"tl","timeRangeMinutes":60}',
        '{"tenantId":"","matchId":"m","timelineId":"tl","timeRangeMinutes":60}',
        '{"matchId":"m","timelineId":"tl","timeRangeMinutes":60}',
        '{"tenantId":"t","matchId":"m","timelineId":"tl","timeRangeMinutes":-1}',
        '{"tenantId":"t","matchId":"m","timelineId":"tl","timeRangeMinutes":"60"}',
        '{"tenantId":1,"matchId":"m","timelineId":"tl","timeRangeMinutes":60}',
        'not json',
    ]
    out = JB.validate_jobs(msgs(spark, values)).collect()
    assert [r["is_valid"] for r in out] == [True, False, False, False, False, False, False]
    assert out[-1]["error_message"] == JB.ERR_UNPARSEABLE and out[1]["error_message"] == JB.ERR_PAYLOAD


def test_explicit_interval_validation_and_use(spark):
    head = '{"tenantId":"t","matchId":"m","timelineId":"tl","timeRangeMinutes":5'
    values = [head + ',"intervalFrom":"2026-05-13T09:00:00.000Z","intervalTo":"2026-05-13T10:00:00.000Z"}',
              head + ',"intervalFrom":"2026-05-13T10:00:00.000Z","intervalTo":"2026-05-13T09:00:00.000Z"}',
              head + ',"intervalTo":"2026-05-13T10:00:00.000Z"}',
              head + ',"intervalFrom":"garbage","intervalTo":"2026-05-13T10:00:00.000Z"}']
    v = JB.validate_jobs(msgs(spark, values)).collect()
    assert [r["error_message"] for r in v] == [None, JB.ERR_ORDER, JB.ERR_ORDER, JB.ERR_FROM]
    jobs = JB.valid_jobs(JB.validate_jobs(msgs(spark, values)), NOW).collect()
    assert len(jobs) == 1 and jobs[0]["intervalFrom"] == datetime(2026, 5, 13, 9) \
        and jobs[0]["intervalTo"] == datetime(2026, 5, 13, 10)


def test_interval_alignment_on_epoch_grid(spark):
    values = ['{"tenantId":"t","matchId":"m","timelineId":"tl","timeRangeMinutes":60}',
              '{"tenantId":"t","matchId":"m","timelineId":"tl","timeRangeMinutes":7.5}']
    out = JB.valid_jobs(JB.validate_jobs(msgs(spark, values)), NOW).collect()
    assert (out[0]["intervalFrom"], out[0]["intervalTo"]) == (datetime(2026, 5, 13, 9), datetime(2026, 5, 13, 10))
    assert (out[1]["intervalFrom"], out[1]["intervalTo"]) == (datetime(2026, 5, 13, 10, 22, 30),
                                                              datetime(2026, 5, 13, 10, 30))


def test_scheduled_expansion(spark):
    targets = spark.createDataFrame([("t1", "m1", ["a", "b"], True), ("t1", "m2", ["c"], False),
                                     ("t9", "m3", ["d"], True)],
                                    "tenantId string, matchId string, timelineIds array<string>, enabled boolean")
    tenants = spark.createDataFrame([("t1", "ACTIVE"), ("t9", "INACTIVE")], "name string, status string")
    jobs = JB.resolve_scheduled(JB.expand_scheduled(targets, tenants, NOW), NOW).collect()
    assert sorted(r["timelineId"] for r in jobs) == ["a", "b"]
    assert all(r["timeRangeMinutes"] == 60 and r["origin"] == "scheduled" and r["retryCount"] == 0 for r in jobs)
    assert [r["matchId"] for r in JB.skipped_targets(targets, tenants).collect()] == ["m3"]
    empty = targets.where("false")
    assert JB.expand_scheduled(empty, tenants, NOW).count() == 0


def test_backfill_expansion_shares_correlation_id(spark):
    req = spark.createDataFrame([("t1", "m1", ["a", "b"], "t1"), ("t1", "m2", ["c"], "t2")],
                                "tenantId string, matchId string, timelineIds array<string>, caller string")
    out = JB.expand_backfill(req, caller_tenant_col="caller", correlation_id="corr-1").collect()
    assert sorted(r["timelineId"] for r in out) == ["a", "b"]
    assert {r["correlationId"] for r in out} == {"corr-1"} and {r["origin"] for r in out} == {"backfill"}
    assert {r["timeRangeMinutes"] for r in out} == {5.0}


def test_encode_roundtrip(spark):
    req = spark.createDataFrame([("t1", "m1", ["a"])], "tenantId string, matchId string, timelineIds array<string>")
    enc = JB.encode_jobs(JB.expand_backfill(req, correlation_id="c")).collect()[0]
    assert enc["key"] == "t1|m1|a" and '"version":1' in enc["value"] and '"jobType"' in enc["value"]


JOB_DDL = "tenantId string, matchId string, timelineId string, intervalFrom timestamp, intervalTo timestamp"


def test_jobs_join_events_broadcast_and_shuffled_agree(spark):
    ev = make_events(spark, [
        {"event_id": 1, "ts": datetime(2026, 5, 13, 9, 59, 59)},
        {"event_id": 2, "ts": datetime(2026, 5, 13, 10, 0, 0)},
        {"event_id": 3, "ts": datetime(2026, 5, 14, 10, 59, 59)},
        {"event_id": 4, "ts": datetime(2026, 5, 13, 10, 30), "environment": "production"},
        {"event_id": 5, "ts": datetime(2026, 5, 13, 10, 30), "media_content_id": None},
    ])
    jobs = spark.createDataFrame(
        [("t1", "m1", "tl-1", datetime(2026, 5, 13, 10), datetime(2026, 5, 14, 11)),
         ("t1", "m1", "tl-1", datetime(2026, 5, 14, 10), datetime(2026, 5, 14, 11))], JOB_DDL)
    a, b = (sorted((r["event_id"], r["intervalFrom"]) for r in
                   JB.jobs_join_events(j, ev, environment="development").collect()) for j in (jobs, jobs.hint("merge")))
    # event 3 belongs to both overlapping jobs; 1 is before the range; 4/5 fail env / match
    assert a == b == [(2, datetime(2026, 5, 13, 10)), (3, datetime(2026, 5, 13, 10)), (3, datetime(2026, 5, 14, 10))]
    both = JB.jobs_join_events(jobs, ev, environment=None)
    assert both.where("event_id = 4").count() == 1
    assert JB.jobs_join_events(jobs.limit(0), ev, environment=None).count() == 0


def test_jobs_of_any_length_equal_plain_comparison(spark):
    """Microsecond to three-year jobs, ends on and off cell borders, times before 1970, repeated and empty jobs."""
    import random
    from datetime import timedelta
    rng = random.Random(5)
    zero = datetime(1969, 12, 31, 12)
    lengths = [1, 2, 1 << 20, (1 << 20) + 1, 3_600_000_000, 1 << 36, 86_400_000_000, 94_608_000_000_000]
    jobs = []
    for n in range(120):
        start = zero + timedelta(microseconds=rng.choice([0, rng.randrange(1 << 21), rng.randrange(200_000_000_000)]))
        jobs.append(("t1", "m1", "tl-1", start, start + timedelta(microseconds=rng.choice(lengths))))
    jobs += [jobs[0], ("t1", "m1", "tl-1", zero, zero)]
    times = [zero + timedelta(microseconds=rng.choice([rng.randrange(1 << 21), rng.randrange(300_000_000_000)])) for _ in range(200)]
    times += [j[3] for j in jobs] + [j[4] for j in jobs]
    ev = make_events(spark, [{"event_id": n, "ts": t} for n, t in enumerate(times)])
    want = sorted((n, j[3], j[4]) for n, t in enumerate(times) for j in set(jobs) if j[3] <= t < j[4])
    for slices, frame in ((1, spark.createDataFrame(jobs, JOB_DDL)), (16, spark.createDataFrame(jobs, JOB_DDL).hint("merge"))):
        got = JB.jobs_join_events(frame, ev, environment="development", slices=slices)
        assert sorted((r["event_id"], r["intervalFrom"], r["intervalTo"]) for r in got.collect()) == want


def test_counts_of_overlapping_jobs_equal_the_joined_rows(spark):
    """Overlapping, empty, repeated and eventless jobs, null ids, events on job ends, several timelines; rows without the operator's counts
    grow with jobs x events, the counted plan makes no joined row beyond one per job."""
    import random
    from datetime import timedelta
    rng, zero = random.Random(8), datetime(2026, 5, 13)
    ev = make_events(spark, [{"event_id": n, "ts": rng.choice([None, *[zero + timedelta(seconds=rng.randrange(3000))] * 20]), "timeline_id": rng.choice(["tl-1", "tl-2", None]),
                              "stage": rng.choice(["rendered", "sent", None]), "environment": rng.choice(["development", "production"])} for n in range(600)])
    jobs = [("t1", rng.choice(["m1", None]), rng.choice(["tl-1", "tl-2", "tl-3"]), a, a + timedelta(seconds=rng.choice([0, 1, 60, 5000, -5])))
            for a in (zero + timedelta(seconds=rng.randrange(3200)) for _ in range(200))]
    jobs = spark.createDataFrame(jobs + jobs[:9] + [("t1", "m1", "tl-1", None, zero)], JOB_DDL)
    ids = ["tenantId", "matchId", "timelineId", "intervalFrom", "intervalTo"]
    for environment in ("development", None):
        want = JB.jobs_join_events(jobs, ev, environment=environment).groupBy(*ids).agg(
            F.count("*").alias("n"), F.count_if(F.col("stage") == "rendered").alias("r"))
        for parts in ("1", "13"):
            before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
            try:
                for k, v in zip(before, (parts, "false"), strict=True):
                    spark.conf.set(k, v)
                got = JB.jobs_join_events(jobs, ev, environment=environment, counts={"n": F.lit(True), "r": F.col("stage") == "rendered"})
                assert sorted(map(tuple, got.select(*ids, "n", "r").collect())) == sorted(map(tuple, want.collect()))
            finally:
                for k, v in before.items():
                    spark.conf.set(k, v)
    assert want.count() > 20
    empty = JB.jobs_join_events(jobs.limit(0), ev, environment=None, counts={"n": F.lit(True)})
    assert empty.count() == 0 and JB.jobs_join_events(jobs, ev.limit(0), environment=None, counts={"n": F.lit(True)}).count() == 0


def test_overlapping_jobs_are_counted_without_the_joined_rows(spark):
    from pulseboard.queries import QUERIES
    plan = QUERIES["jobs_join_events_mixed"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert not [x for x in plan.splitlines() if "Join" in x and (">=" in x or "_cell" in x)]


def test_a_hot_live_match_is_joined_by_many_tasks(spark):
    """All events in one job: the shuffle key holds the slice, and no task gets more than a small part."""
    ev = spark.range(16_000).selectExpr(
        "id AS event_id", "timestamp_micros(1778666400000000 + id * 1000) AS ts", "'t1' AS tenant_id",
        "'m1' AS media_content_id", "'tl-1' AS timeline_id", "'development' AS environment")
    jobs = spark.createDataFrame([("t1", "m1", "tl-1", datetime(2026, 5, 13, 10), datetime(2026, 5, 13, 11))], JOB_DDL)
    out = JB.jobs_join_events(jobs.hint("merge"), ev, environment="development", slices=16)
    assert "_slice" in "".join(x for x in out._jdf.queryExecution().executedPlan().toString().splitlines(True)
                               if "hashpartitioning" in x and "_cell" in x)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert sum(sizes) == 16_000 and len(sizes) >= 4 and max(sizes) <= 8_000


def test_fixture_inputs_follow_the_rules(spark):
    from pulseboard.sources.events import fixture_events
    ev = fixture_events(spark, "/root/testdata/sf0.001")
    t = JS.fixture_targets(ev)
    assert t.where(~F.col("enabled")).select("matchId").distinct().collect()[0][0] == "match-4"
    assert {r["name"]: r["status"] for r in JS.fixture_tenants(ev).collect()}["tenant-2"] == "INACTIVE"


def test_reference_payload_cases(spark):
    """Four rejected payloads and the valid one of the reference's missing-data case."""
    import json
    valid = {"timeRangeMinutes": 5, "timelineId": "tl-1", "tenantId": "t1", "matchId": "match-1"}
    bad = [{"timeRangeMinutes": 5}, {"timeRangeMinutes": 5, "tenantId": "t1", "matchId": "match-1"},
           {"timeRangeMinutes": 5, "timelineId": "tl-1", "matchId": "match-1"},
           {"timeRangeMinutes": 5, "timelineId": "", "tenantId": "t1", "matchId": "match-1"}]
    out = JB.validate_jobs(msgs(spark, [json.dumps(p) for p in [valid, *bad]])).collect()
    assert [r["is_valid"] for r in out] == [True, False, False, False, False]
    assert {r["error_message"] for r in out[1:]} == {JB.ERR_PAYLOAD}

"""Match rollup, accumulate / idempotent upserts (rerun cases of the reference), on-disk sink."""

from datetime import datetime

from pyspark.sql import functions as F

from pulseboard.plans import store as ST
from pulseboard.session import ensure_checkpoint_dir

T0 = datetime(2026, 5, 13, 10)
T1 = datetime(2026, 5, 13, 11)
COLS = ("timelineId string, matchId string, tenantId string, platform string, sent double, received long, "
        "rendered long, failed long, receiveRate double, renderRate double, failureRate double, "
        "netSuccessRate double, avgRenderMs double, intervalFrom timestamp, intervalTo timestamp")


def prow(tl, platform, sent, rec, ren, fail, rr, avg, frm=T0):
    return (tl, "m1", "t1", platform, float(sent), rec, ren, fail, rr, 0.0, 0.0, 0.0, avg, frm, T1)


def test_accumulate_rerun_adds_and_last_write_sets(spark):
    run1 = spark.createDataFrame([prow("tl-1", "web", 50, 46, 42, 4, 92.0, 100.0)], COLS)
    run2 = spark.createDataFrame([prow("tl-2", "web", 70, 66, 61, 4, 94.29, 116.0)], COLS)
    stored = ST.upsert(None, run1, "platform")
    r = ST.upsert(stored, run2, "platform").collect()[0]
    assert (r["sent"], r["received"], r["rendered"], r["failed"]) == (120.0, 112, 103, 8)
    assert r["receiveRate"] == 94.29 and r["timelineId"] == "tl-2"


def test_accumulate_inserts_new_keys(spark):
    a = spark.createDataFrame([prow("tl-1", p, s, 1, 1, 0, 0.0, 0.0) for p, s in
                               [("web", 50), ("ios", 30), ("android", 20)]], COLS)
    b = spark.createDataFrame([prow("tl-2", p, s, 1, 1, 0, 0.0, 0.0) for p, s in
                               [("web", 45), ("ios", 50), ("android", 35), ("smarttv", 20)]], COLS)
    out = {r["platform"]: r["sent"] for r in ST.upsert(ST.upsert(None, a, "platform"), b, "platform").collect()}
    assert out == {"web": 95.0, "ios": 80.0, "android": 55.0, "smarttv": 20.0}


def test_rollup_last_writer_order(spark):
    rows = spark.createDataFrame([prow("tl-b", "web", 1, 1, 1, 0, 10.0, 1.0), prow("tl-a", "web", 2, 1, 1, 0, 20.0, 2.0)],
                                 COLS)
    r = ST.match_rollup(rows, "platform").collect()[0]
    assert r["sent"] == 3.0 and r["timelineId"] == "tl-b" and r["receiveRate"] == 10.0


def test_device_key_has_no_platform(spark):
    from pulseboard.schema import METRIC_META
    assert "platform" not in METRIC_META["device"].unique
    assert METRIC_META["latency"].accumulate == ()


def test_idempotent_rerun_equals_single_run(spark):
    run = spark.createDataFrame([prow("tl-1", "web", 50, 46, 42, 4, 92.0, 100.0),
                                 prow("tl-2", "web", 70, 66, 61, 4, 94.29, 116.0)], COLS)
    once = ST.idempotent_upsert(None, run, "platform").collect()
    twice = ST.idempotent_upsert(run, run, "platform").collect()
    assert once == twice and once[0]["sent"] == 120.0


def test_on_disk_sink_modes(spark, tmp_path):
    ensure_checkpoint_dir(spark)
    run = spark.createDataFrame([prow("tl-1", "web", 50, 46, 42, 4, 92.0, 100.0)], COLS)
    idem, acc = str(tmp_path / "idem"), str(tmp_path / "acc")
    for _ in range(2):
        ST.upsert_table(spark, idem, run, "platform", mode="idempotent")
        ST.upsert_table(spark, acc, run, "platform", mode="accumulate", now="2026-05-13T12:00:00Z")
    assert spark.read.parquet(idem).collect()[0]["sent"] == 50.0
    a = spark.read.parquet(acc).collect()[0]
    assert a["sent"] == 100.0 and a["createdAt"] == datetime(2026, 5, 13, 12)
    # another tenant-day partition is untouched by a later upsert
    other = spark.createDataFrame([prow("tl-1", "web", 5, 1, 1, 0, 0.0, 0.0, frm=datetime(2026, 5, 20, 10))], COLS)
    ST.upsert_table(spark, idem, other, "platform", mode="idempotent")
    assert spark.read.parquet(idem).count() == 2


def test_read_sorted_desc_and_retention(spark):
    from pulseboard.operators.predicates import MetricQuery
    rows = spark.createDataFrame([prow("tl-1", "web", 1, 1, 1, 0, 0.0, 0.0, frm=datetime(2026, 1, d)) for d in (1, 3, 2)],
                                 COLS)
    got = [r["intervalFrom"].day for r in ST.read_metric(rows, "platform", MetricQuery(tenant_id="t1")).collect()]
    assert got == [3, 2, 1]
    kept = ST.retention_prune(rows, "2026-04-02T00:00:00Z").collect()  # cutoff 2026-01-02
    assert sorted(r["intervalFrom"].day for r in kept) == [2, 3]
    assert rows.where(F.col("tenantId") == "t1").count() == 3


def test_idempotent_audit_times(spark, tmp_path):
    ensure_checkpoint_dir(spark)
    run = spark.createDataFrame([prow("tl-1", "web", 50, 46, 42, 4, 92.0, 100.0),
                                 prow("tl-2", "web", 70, 66, 61, 4, 94.29, 116.0)], COLS)
    path = str(tmp_path / "idem")
    ST.upsert_table(spark, path, run, "platform", now="2026-05-13T12:00:00Z")
    ST.upsert_table(spark, path, run.where("timelineId = 'tl-2'"), "platform", now="2026-05-13T13:00:00Z")
    r = spark.read.parquet(path).collect()
    assert len(r) == 1 and r[0]["sent"] == 120.0
    assert r[0]["createdAt"] == datetime(2026, 5, 13, 12) and r[0]["updatedAt"] == datetime(2026, 5, 13, 13)
    c = {x["timelineId"]: x for x in spark.read.parquet(path + "_contrib").collect()}
    assert c["tl-2"]["createdAt"] == datetime(2026, 5, 13, 12) and c["tl-2"]["updatedAt"] == datetime(2026, 5, 13, 13)


def _jobs(rows):
    return rows.select("tenantId", "matchId", "timelineId", "intervalFrom", "intervalTo").distinct()


def test_rerun_clears_vanished_jobs_and_empties_partitions(spark, tmp_path):
    ensure_checkpoint_dir(spark)
    cols = [c.split()[0] for c in COLS.split(", ")]
    day2 = datetime(2026, 5, 14, 10)
    rows = spark.createDataFrame([prow("tl-1", "web", 5, 1, 1, 0, 0.0, 0.0), prow("tl-2", "web", 7, 1, 1, 0, 0.0, 0.0),
                                  prow("tl-3", "web", 9, 1, 1, 0, 0.0, 0.0, frm=day2)], COLS)
    rows = rows.withColumn("tenantId", F.lit("00 1/2"))
    path = str(tmp_path / "platform")
    ST.upsert_table(spark, path, rows, "platform", jobs=_jobs(rows))
    ST.upsert_table(spark, path, rows.where("timelineId = 'tl-1'"), "platform", jobs=_jobs(rows))
    for at in (path, path + "_contrib"):
        got = ST.read_table(spark, at).select(cols).collect()
        assert [(r["tenantId"], r["sent"], r["intervalFrom"]) for r in got] == [("00 1/2", 5.0, T0)]


def test_jobs_of_one_start_and_different_ends_both_count(spark, tmp_path):
    ensure_checkpoint_dir(spark)
    hour = spark.createDataFrame([prow("tl-1", "web", 12, 1, 1, 0, 0.0, 0.0)], COLS)
    short = hour.withColumns({"sent": F.lit(5.0), "intervalTo": F.lit(datetime(2026, 5, 13, 10, 5))})
    path = str(tmp_path / "platform")
    for rows in (hour, short, short):
        ST.upsert_table(spark, path, rows, "platform", jobs=_jobs(rows))
    assert ST.read_table(spark, path).collect()[0]["sent"] == 17.0


def test_stored_read_prunes_tenant_and_day(spark, tmp_path):
    from pulseboard.operators.predicates import MetricQuery
    rows = spark.createDataFrame([prow("tl-1", "web", d, 1, 1, 0, 0.0, 0.0, frm=datetime(2026, 5, d, 10)) for d in (1, 2, 3)], COLS)
    path = str(tmp_path / "platform")
    ST.upsert_table(spark, path, rows, "platform")
    q = MetricQuery(tenant_id="t1", start="2026-05-02T00:00:00Z", end="2026-05-02T23:00:00Z")
    got = ST.scan_metric(spark, path, "platform", q)
    assert [r["sent"] for r in got.collect()] == [2.0]
    plan = got._jdf.queryExecution().toString()
    filters = next(x for x in plan.splitlines() if "PartitionFilters" in x)
    pruned = filters.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "tenantId" in pruned and "intervalDate" in pruned


def test_retention_removes_stored_rows_and_contributions(spark, tmp_path):
    from pulseboard.operators.predicates import MetricQuery
    rows = spark.createDataFrame([("tl-1", "m1", "t1", "sent", "5m", datetime(2026, 1, d, 10), 1.0, datetime(2026, 1, d, 10), datetime(2026, 1, d, 11))
                                  for d in (1, 2, 3)], "timelineId string, matchId string, tenantId string, metric string, "
                                 "interval string, time timestamp, value double, intervalFrom timestamp, intervalTo timestamp")
    path = str(tmp_path / "timeseries")
    ST.upsert_table(spark, path, rows, "timeseries")
    ST.expire_table(spark, path, "2026-04-03T00:00:00Z")  # cutoff 2026-01-03
    for at in (path, path + "_contrib"):
        assert [r["time"].day for r in ST.read_table(spark, at).collect()] == [3]
    assert ST.scan_metric(spark, path, "timeseries", MetricQuery(tenant_id="t1")).count() == 1


def test_stream_sink_refuses_accumulate():
    import pytest

    from pulseboard.streaming.sinks import metric_upsert_sink
    with pytest.raises(ValueError):
        metric_upsert_sink("unused", "platform", mode="accumulate")


def test_long_job_lists_join_by_a_shuffle(spark):
    from pulseboard.queries import QUERIES
    plan = QUERIES["jobs_join_events_bucketed"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin [tenant_id" not in plan

"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Each reads the driver's tables (through the fixture adapter) in full, so its
work grows with the data.  ``ORACLES`` holds the DuckDB statement of the same
name; keys without an oracle are checked rows-only by the driver.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseboard import oracle as O
from pulseboard.operators import metrics as M
from pulseboard.operators.context import grid_context, match_level
from pulseboard.operators.predicates import EventQuery, event_predicate
from pulseboard.sources.events import FLAT_COLUMNS
from pulseboard.sources.events import fixture_events as _fixture_events

# Job grid of the registered per-job queries: one job per timeline and UTC day
# (a backfill-style 1440-minute range), plus an hourly variant (the scheduler's
# 60-minute cadence).
DAILY = 1440
HOURLY = 60
ENVIRONMENT = "development"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


_FIXTURE_CACHE: dict[tuple[int, str], tuple[SparkSession, DataFrame]] = {}


def fixture_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mapped event frame, built once per session and folder.

    Only the (immutable) logical plan is reused - no data is cached - which
    saves re-reading the Parquet footer and re-analysing the projection.
    """
    key = (id(spark), sf_dir)
    hit = _FIXTURE_CACHE.get(key)
    if hit is not None and hit[0] is spark and spark.sparkContext._jsc is not None:
        return hit[1]
    df = _fixture_events(spark, sf_dir)
    _FIXTURE_CACHE[key] = (spark, df)
    return df


def etl_base(spark: SparkSession, sf_dir: str, minutes: float = DAILY) -> DataFrame:
    return grid_context(fixture_events(spark, sf_dir), minutes, environment=ENVIRONMENT)


# ------------------------------------------------------------------ S1/S2
@register("tracking_events", O.with_(O.FIXTURE_VIEW) + "SELECT " + ", ".join(FLAT_COLUMNS) + " FROM te")
def q_tracking_events(spark, sf_dir):
    return fixture_events(spark, sf_dir)


# ------------------------------------------------------------------ P1/P2
BASE_FILTER_Q = EventQuery(tenant_id="tenant-1", start="2024-01-05T00:00:00Z", end="2024-01-20T00:00:00.000Z")
BASE_FILTER_FULL_Q = EventQuery(tenant_id="tenant-2", timeline_ids=("tl-2", "tl-5", "tl-8", "tl-29"),
                                media_content_id="match-2", start="2024-01-03T12:00:00+02:00",
                                end="2024-01-28T00:00:00Z", platform="ios", environment=None)


@register("base_filter", O.with_(O.FIXTURE_VIEW) + "SELECT " + ", ".join(FLAT_COLUMNS) + """ FROM te
WHERE tenant_id = 'tenant-1' AND environment = 'development'
  AND ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-20 00:00:00'""")
def q_base_filter(spark, sf_dir):
    return fixture_events(spark, sf_dir).where(event_predicate(BASE_FILTER_Q))


@register("base_filter_full", O.with_(O.FIXTURE_VIEW) + "SELECT " + ", ".join(FLAT_COLUMNS) + """ FROM te
WHERE tenant_id = 'tenant-2' AND timeline_id IN ('tl-2', 'tl-5', 'tl-8', 'tl-29')
  AND media_content_id = 'match-2' AND platform = 'ios'
  AND ts >= TIMESTAMP '2024-01-03 10:00:00' AND ts < TIMESTAMP '2024-01-28 00:00:00'""")
def q_base_filter_full(spark, sf_dir):
    return fixture_events(spark, sf_dir).where(event_predicate(BASE_FILTER_FULL_Q))


# ------------------------------------------------------------------ A3
@register("platform_metrics", O.with_(O.FIXTURE_VIEW, O.grid_base(DAILY), O.platform_cte())
          + f"SELECT {O.PLATFORM_COLS} FROM plat")
def q_platform_metrics(spark, sf_dir):
    return M.platform_metrics(etl_base(spark, sf_dir))


@register("platform_metrics_hourly", O.with_(O.FIXTURE_VIEW, O.grid_base(HOURLY), O.platform_cte())
          + f"SELECT {O.PLATFORM_COLS} FROM plat")
def q_platform_metrics_hourly(spark, sf_dir):
    return M.platform_metrics(etl_base(spark, sf_dir, HOURLY))


@register("top_platforms", O.with_(O.FIXTURE_VIEW, O.grid_base(DAILY), O.platform_cte(top_n=2))
          + f"SELECT {O.PLATFORM_COLS} FROM plat")
def q_top_platforms(spark, sf_dir):
    return M.platform_metrics(etl_base(spark, sf_dir), top_n=2)


# ------------------------------------------------------------------ A4 / P10
DEVICE_COLS = ("timelineId, matchId, tenantId, dimension, bucketKey, received, rendered, failed, "
               "renderRate, avgRenderMs, intervalFrom, intervalTo")


@register("device_breakdown", O.with_(O.FIXTURE_VIEW, O.grid_base(DAILY), O.device_cte())
          + f"SELECT {DEVICE_COLS} FROM dev")
def q_device_breakdown(spark, sf_dir):
    return M.device_breakdown(etl_base(spark, sf_dir))


for _dim, _col, _key in [("browser", "browser", "device_browser"), ("os", "client_os", "device_os"),
                         ("deviceClass", "device_class", "device_class")]:
    register(_key, O.with_(O.FIXTURE_VIEW, O.grid_base(DAILY), O.device_cte(dims=[(_dim, _col)]))
             + f"SELECT {DEVICE_COLS} FROM dev")(
        lambda spark, sf_dir, _d=_dim: M.device_breakdown(etl_base(spark, sf_dir), [_d]))


@register("device_small_topk", O.with_(O.FIXTURE_VIEW, O.grid_base(DAILY), O.device_cte(top_n=2))
          + f"SELECT {DEVICE_COLS} FROM dev")
def q_device_small_topk(spark, sf_dir):
    return M.device_breakdown(etl_base(spark, sf_dir), top_n=2)


# ------------------------------------------------------------------ A5
TRANSPORT_COLS = "timelineId, matchId, tenantId, transportMode, count, renderRate, avgRenderMs, p95RenderMs, intervalFrom, intervalTo"


@register("transport_comparison", O.with_(O.FIXTURE_VIEW, O.grid_base(DAILY), O.transport_cte())
          + f"SELECT {TRANSPORT_COLS} FROM tr")
def q_transport(spark, sf_dir):
    return M.transport_comparison(etl_base(spark, sf_dir))


# ------------------------------------------------------------------ A6
SDK_COLS = "timelineId, matchId, tenantId, sdkVersion, count, renderRate, avgRenderMs, intervalFrom, intervalTo"


@register("sdk_versions", O.with_(O.FIXTURE_VIEW, O.grid_base(DAILY), O.sdk_cte())
          + f"SELECT {SDK_COLS} FROM sdk")
def q_sdk(spark, sf_dir):
    return M.sdk_versions(etl_base(spark, sf_dir))


# ------------------------------------------------------------------ A7 / W1 / L2
FAILURE_COLS = "timelineId, matchId, tenantId, failureReason, failureStep, count, percentOfFailed, intervalFrom, intervalTo"


@register("failure_analysis", O.with_(O.FIXTURE_VIEW, O.grid_base(DAILY), O.failure_cte())
          + f"SELECT {FAILURE_COLS} FROM fail")
def q_failure(spark, sf_dir):
    return M.failure_analysis(etl_base(spark, sf_dir))


@register("failure_topk", O.with_(O.FIXTURE_VIEW, O.grid_base(DAILY), O.failure_cte(top_reasons=2, top_steps=2))
          + f"SELECT {FAILURE_COLS} FROM fail")
def q_failure_topk(spark, sf_dir):
    return M.failure_analysis(etl_base(spark, sf_dir), top_reasons=2, top_steps=2)


# ------------------------------------------------------------------ A8-A10
@register("latency_percentiles", O.with_(O.FIXTURE_VIEW, O.grid_base(DAILY), O.latency_cte())
          + "SELECT * FROM lat")
def q_latency(spark, sf_dir):
    return M.latency_percentiles(etl_base(spark, sf_dir))


def _stats_sql() -> str:
    cols = []
    for name, col in O.LAT_SERIES:
        cols += [f"COUNT({col}) AS {name}_count", f"{O.r2(f'MIN({col})')} AS {name}_min",
                 f"{O.r2(f'MAX({col})')} AS {name}_max", f"{O.r2(O.xavg(col))} AS {name}_avg",
                 f"{O.r2(O.xsum(col))} AS {name}_sum"]
    return (O.with_(O.FIXTURE_VIEW, O.grid_base(DAILY))
            + f"SELECT {O.CTX}, " + ", ".join(cols) + f" FROM base GROUP BY {O.CTX}")


@register("latency_stats", _stats_sql())
def q_latency_stats(spark, sf_dir):
    from pulseboard.functions.numeric import r2
    raw = M.latency_aggregates(etl_base(spark, sf_dir), with_stats=True)
    cols = [F.col(c) for c in ["tenantId", "matchId", "timelineId", "intervalFrom", "intervalTo"]]
    for name in M.LATENCY_SERIES:
        cols += [F.col(f"{name}_count"), r2(f"{name}_min_raw").alias(f"{name}_min"),
                 r2(f"{name}_max_raw").alias(f"{name}_max"), r2(f"{name}_avg_raw").alias(f"{name}_avg"),
                 r2(f"{name}_sum_raw").alias(f"{name}_sum")]
    return raw.select(*cols)


# ------------------------------------------------------------------ A11 / T2 / T4 / J5
@register("timeseries_all", O.with_(O.FIXTURE_VIEW, O.grid_base(DAILY), O.timeseries_cte())
          + O.timeseries_long())
def q_timeseries_all(spark, sf_dir):
    return M.timeseries(etl_base(spark, sf_dir))


for _m in ["sent", "received", "rendered", "failed", "avgRenderMs"]:
    register(f"timeseries_{_m}", O.with_(O.FIXTURE_VIEW, O.grid_base(DAILY), O.timeseries_cte())
             + O.timeseries_long(metrics=[_m]))(
        lambda spark, sf_dir, _mm=_m: M.timeseries(etl_base(spark, sf_dir), [_mm]))


@register("timeseries_hourly_jobs", O.with_(O.FIXTURE_VIEW, O.grid_base(HOURLY), O.timeseries_cte())
          + O.timeseries_long())
def q_timeseries_hourly(spark, sf_dir):
    return M.timeseries(etl_base(spark, sf_dir, HOURLY))


# ------------------------------------------------------------------ realtime
from pulseboard.operators.predicates import RealtimeQuery  # noqa: E402
from pulseboard.operators.realtime import Realtime  # noqa: E402

RT_NOW = "2024-02-01T00:00:00Z"
RT_RANGE = RealtimeQuery(start="2024-01-08T00:00:00Z", end="2024-01-22T00:00:00Z")
RT_TIMELINES = RealtimeQuery(timeline_ids=("tl-1", "tl-4", "tl-7", "tl-22"), match_id="match-1",
                             start="2024-01-02T00:00:00Z", end="2024-01-29T00:00:00Z")
RT_QUESTION = RealtimeQuery(question_id="tl-3", platform="web", match_id="match-3")
RT_MATCH = RealtimeQuery(match_id="match-2")

_RT_RANGE_SQL = O.rt_base("ts >= TIMESTAMP '2024-01-08 00:00:00' AND ts < TIMESTAMP '2024-01-22 00:00:00'",
                          start="2024-01-08 00:00:00", end="2024-01-22 00:00:00")
_RT_TL_SQL = O.rt_base("timeline_id IN ('tl-1', 'tl-4', 'tl-7', 'tl-22') AND ts >= TIMESTAMP '2024-01-02 00:00:00' "
                       "AND ts < TIMESTAMP '2024-01-29 00:00:00'", match_id="match-1", timeline_id="tl-1",
                       start="2024-01-02 00:00:00", end="2024-01-29 00:00:00")
_RT_Q_SQL = O.rt_base("timeline_id IN ('tl-3') AND platform = 'web'", match_id="match-3", timeline_id="tl-3")
_RT_M_SQL = O.rt_base("media_content_id = 'match-2'", match_id="match-2")


def _rt(spark, sf_dir, q):
    return Realtime(fixture_events(spark, sf_dir), q, None, RT_NOW)


@register("realtime_funnel", O.with_(O.FIXTURE_VIEW, _RT_RANGE_SQL, O.platform_cte(src="rtb"))
          + O.rt_funnel_select())
def q_rt_funnel(spark, sf_dir):
    return _rt(spark, sf_dir, RT_RANGE).funnel()


@register("realtime_funnel_timelines", O.with_(O.FIXTURE_VIEW, _RT_TL_SQL, O.platform_cte(src="rtb"))
          + O.rt_funnel_select())
def q_rt_funnel_tl(spark, sf_dir):
    return _rt(spark, sf_dir, RT_TIMELINES).funnel()


@register("heatmap", O.with_(O.FIXTURE_VIEW, _RT_RANGE_SQL, O.platform_cte(src="rtb"))
          + "SELECT tenantId, platform, sent, received, rendered, failed FROM plat")
def q_heatmap(spark, sf_dir):
    return _rt(spark, sf_dir, RT_RANGE).heatmap()


@register("realtime_failures", O.with_(O.FIXTURE_VIEW, _RT_Q_SQL, O.failure_cte(src="rtb"))
          + "SELECT tenantId, failureReason, failureStep, count, percentOfFailed FROM fail")
def q_rt_failures(spark, sf_dir):
    return _rt(spark, sf_dir, RT_QUESTION).failures()


@register("realtime_device_os", O.with_(O.FIXTURE_VIEW, _RT_TL_SQL, O.device_cte(src="rtb", dims=[("os", "client_os")]))
          + "SELECT tenantId, bucketKey AS dimension, received, rendered, failed, renderRate, avgRenderMs FROM dev")
def q_rt_device(spark, sf_dir):
    return _rt(spark, sf_dir, RT_TIMELINES).device("os")


@register("realtime_device_fallback", O.with_(O.FIXTURE_VIEW, _RT_RANGE_SQL, O.device_cte(src="rtb", dims=[("unsupported-dimension", "browser")]))
          + "SELECT tenantId, bucketKey AS dimension, received, rendered, failed, renderRate, avgRenderMs FROM dev")
def q_rt_device_fallback(spark, sf_dir):
    return _rt(spark, sf_dir, RT_RANGE).device("unsupported-dimension")


@register("realtime_transport", O.with_(O.FIXTURE_VIEW, _RT_M_SQL, O.transport_cte(src="rtb"))
          + "SELECT tenantId, transportMode, count, renderRate, avgRenderMs, p95RenderMs FROM tr")
def q_rt_transport(spark, sf_dir):
    return _rt(spark, sf_dir, RT_MATCH).transport()


@register("realtime_sdk", O.with_(O.FIXTURE_VIEW, _RT_RANGE_SQL, O.sdk_cte(src="rtb"))
          + "SELECT tenantId, sdkVersion, count, renderRate, avgRenderMs FROM sdk")
def q_rt_sdk(spark, sf_dir):
    return _rt(spark, sf_dir, RT_RANGE).sdk()


@register("realtime_timeseries_1m", O.with_(O.FIXTURE_VIEW, _RT_TL_SQL, O.timeseries_cte(src="rtb", interval="1m"))
          + "SELECT tenantId, time, sent AS value FROM tsr_wide")
def q_rt_ts_1m(spark, sf_dir):
    return _rt(spark, sf_dir, RT_TIMELINES).timeseries()


@register("realtime_timeseries_1h", O.with_(O.FIXTURE_VIEW, _RT_M_SQL, O.timeseries_cte(src="rtb", interval="1h"))
          + "SELECT tenantId, time, rendered AS value FROM tsr_wide")
def q_rt_ts_1h(spark, sf_dir):
    return _rt(spark, sf_dir, RT_MATCH).timeseries("rendered", "1h")


@register("realtime_latency", O.with_(O.FIXTURE_VIEW, _RT_M_SQL, O.latency_cte(src="rtb"))
          + "SELECT * FROM lat")
def q_rt_latency(spark, sf_dir):
    return _rt(spark, sf_dir, RT_MATCH).latency()


@register("funnel_debug", O.with_(O.FIXTURE_VIEW, _RT_RANGE_SQL, O.platform_cte(src="rtb"))
          + "SELECT tenantId, platform, doc_count, sent_raw, received_raw, rendered_raw, failed_raw, avg_render_raw, "
            "sent, received, rendered, failed, receiveRate, renderRate, failureRate, netSuccessRate, avgRenderMs, "
            "$$tenant_id IS NOT NULL AND ts >= '2024-01-08T00:00:00.000000Z' AND ts < '2024-01-22T00:00:00.000000Z'$$ AS predicate FROM plat")
def q_funnel_debug(spark, sf_dir):
    return _rt(spark, sf_dir, RT_RANGE).funnel_debug()


@register("latency_debug", O.with_(O.FIXTURE_VIEW, _RT_TL_SQL, O.latency_cte(src="rtb"))
          + "SELECT * EXCLUDE (timelineId, matchId, intervalFrom, intervalTo, receive_lst, render_lst, ack_lst), "
            "$$tenant_id IS NOT NULL AND timeline_id IN ('tl-1', 'tl-4', 'tl-7', 'tl-22') AND ts >= '2024-01-02T00:00:00.000000Z' "
            "AND ts < '2024-01-29T00:00:00.000000Z'$$ AS predicate FROM lat_raw JOIN "
            "(SELECT * EXCLUDE (timelineId, matchId, intervalFrom, intervalTo) FROM lat) USING (tenantId)")
def q_latency_debug(spark, sf_dir):
    return _rt(spark, sf_dir, RT_TIMELINES).latency_debug()


# ------------------------------------------------------------------ jobs
from pulseboard.plans import jobs as JB  # noqa: E402
from pulseboard.sources import jobs as JS  # noqa: E402

JOB_NOW = "2024-01-15T10:30:00Z"
_JOB_NOW_SQL = "TIMESTAMP '2024-01-15 10:30:00'"
_JOBS_SQL = O.with_(O.FIXTURE_VIEW, O.job_inputs())
_VAL_SQL = O.with_(O.FIXTURE_VIEW, O.job_inputs(), O.validate_cte())
_AL_FROM, _AL_TO = O.align_sql(_JOB_NOW_SQL)


def _validated(spark, sf_dir):
    return JB.validate_jobs(JS.fixture_job_messages(fixture_events(spark, sf_dir), JOB_NOW))


@register("job_expansion", _JOBS_SQL + f"""SELECT tenantId, matchId, timelineId, timeRangeMinutes, retryCount, origin,
  scheduledAt, {_AL_FROM} AS intervalFrom, {_AL_TO} AS intervalTo FROM sched""")
def q_job_expansion(spark, sf_dir):
    ev = fixture_events(spark, sf_dir)
    jobs = JB.expand_scheduled(JS.fixture_targets(ev), JS.fixture_tenants(ev), JOB_NOW)
    return JB.resolve_scheduled(jobs, JOB_NOW).drop("explicitFrom", "explicitTo")


@register("job_skipped_targets", _JOBS_SQL + """SELECT tenantId, matchId, array_to_string(timelineIds, ',') AS timelineIds
FROM targets WHERE enabled AND tenantId NOT IN (SELECT name FROM tenants WHERE status = 'ACTIVE')""")
def q_job_skipped(spark, sf_dir):
    ev = fixture_events(spark, sf_dir)
    return JB.skipped_targets(JS.fixture_targets(ev), JS.fixture_tenants(ev)).select(
        "tenantId", "matchId", F.array_join("timelineIds", ",").alias("timelineIds"))


@register("backfill_expansion", _JOBS_SQL + "SELECT * FROM backfill")
def q_backfill_expansion(spark, sf_dir):
    req = JS.fixture_backfill_requests(JS.fixture_targets(fixture_events(spark, sf_dir)))
    return JB.expand_backfill(req, caller_tenant_col="callerTenant", correlation_id="correlationKey")


@register("job_validation", _VAL_SQL + "SELECT * FROM val")
def q_job_validation(spark, sf_dir):
    return _validated(spark, sf_dir)


@register("job_messages", _VAL_SQL + """SELECT tenantId || '|' || matchId || '|' || timelineId AS key, version, jobType,
  tenantId, matchId, timelineId, timeRangeMinutes, retryCount, origin, correlationId FROM val WHERE is_valid""")
def q_job_messages(spark, sf_dir):
    v = _validated(spark, sf_dir).where("is_valid")
    return v.select(JB.job_key().alias("key"), "version", "jobType", "tenantId", "matchId", "timelineId",
                    "timeRangeMinutes", "retryCount", "origin", "correlationId")


@register("job_dead_letters", _VAL_SQL + """SELECT value, error_message AS errorMessage,
  TIMESTAMP '2024-01-15 10:30:00' AS failedAt FROM val WHERE NOT is_valid""")
def q_job_dead_letters(spark, sf_dir):
    return JB.dead_letters(_validated(spark, sf_dir), JOB_NOW)


@register("interval_alignment", _VAL_SQL + f"""SELECT tenantId, matchId, timelineId, timeRangeMinutes,
  CASE WHEN explicitFrom IS NOT NULL AND explicitTo IS NOT NULL THEN explicitFrom ELSE {_AL_FROM} END AS intervalFrom,
  CASE WHEN explicitFrom IS NOT NULL AND explicitTo IS NOT NULL THEN explicitTo ELSE {_AL_TO} END AS intervalTo
FROM val WHERE is_valid""")
def q_interval_alignment(spark, sf_dir):
    return JB.valid_jobs(_validated(spark, sf_dir), JOB_NOW).select(
        "tenantId", "matchId", "timelineId", "timeRangeMinutes", "intervalFrom", "intervalTo")


def _backfill_jobs(spark, sf_dir):
    """K2 -> JSON -> validation (as a consumer would) -> jobs with explicit intervals."""
    ev = fixture_events(spark, sf_dir)
    req = JS.fixture_backfill_requests(JS.fixture_targets(ev))
    jobs = JB.expand_backfill(req, caller_tenant_col="callerTenant", correlation_id="correlationKey")
    return ev, JB.valid_jobs(JB.validate_jobs(JB.encode_jobs(jobs)), JOB_NOW)


_BF_SQL = O.with_(O.FIXTURE_VIEW, O.job_inputs(), f"bmsgs AS ({O.encoded_backfill()})",
                  O.validate_cte(src="bmsgs", name="bval"),
                  """bjobs AS (SELECT DISTINCT tenantId, matchId, timelineId, explicitFrom AS intervalFrom,
                              explicitTo AS intervalTo FROM bval WHERE is_valid)""",
                  """jbase AS (SELECT j.tenantId, j.matchId, j.timelineId, j.intervalFrom, j.intervalTo, te.*
                     FROM te JOIN bjobs j ON te.tenant_id = j.tenantId AND te.timeline_id = j.timelineId
                      AND te.media_content_id = j.matchId AND te.ts >= j.intervalFrom AND te.ts < j.intervalTo
                     WHERE te.environment = 'development')""")


@register("jobs_join_events", _BF_SQL + """SELECT tenantId, matchId, timelineId, intervalFrom, intervalTo, event_id, ts,
  stage FROM jbase""")
def q_jobs_join_events(spark, sf_dir):
    ev, jobs = _backfill_jobs(spark, sf_dir)
    return JB.jobs_join_events(jobs, ev, environment=ENVIRONMENT).select(
        "tenantId", "matchId", "timelineId", "intervalFrom", "intervalTo", "event_id", "ts", "stage")


@register("jobs_join_events_bucketed", _BF_SQL + """SELECT tenantId, matchId, timelineId, intervalFrom, intervalTo,
  event_id, ts, stage FROM jbase""")
def q_jobs_join_events_bucketed(spark, sf_dir):
    """Same join by a shuffle (what the optimizer takes for a job list that is too big to broadcast)."""
    ev, jobs = _backfill_jobs(spark, sf_dir)
    return JB.jobs_join_events(jobs.hint("merge"), ev, environment=ENVIRONMENT).select(
        "tenantId", "matchId", "timelineId", "intervalFrom", "intervalTo", "event_id", "ts", "stage")


_BF_CTES = [O.FIXTURE_VIEW, O.job_inputs(), f"bmsgs AS ({O.encoded_backfill()})",
             O.validate_cte(src="bmsgs", name="bval"),
             """bjobs AS (SELECT DISTINCT tenantId, matchId, timelineId, explicitFrom AS intervalFrom,
                         explicitTo AS intervalTo FROM bval WHERE is_valid)""",
             """jbase AS (SELECT j.tenantId, j.matchId, j.timelineId, j.intervalFrom, j.intervalTo, te.*
                FROM te JOIN bjobs j ON te.tenant_id = j.tenantId AND te.timeline_id = j.timelineId
                 AND te.media_content_id = j.matchId AND te.ts >= j.intervalFrom AND te.ts < j.intervalTo
                WHERE te.environment = 'development')"""]


_MIXED_MINUTES = "CASE event_id % 3 WHEN 0 THEN 1 WHEN 1 THEN 60 ELSE 1440 END"


@register("jobs_join_events_mixed", O.with_(O.FIXTURE_VIEW, f"""mjobs AS (
  SELECT DISTINCT tenant_id AS tenantId, media_content_id AS matchId, timeline_id AS timelineId, ts AS intervalFrom,
         ts + {_MIXED_MINUTES} * INTERVAL 1 MINUTE AS intervalTo FROM te WHERE stage = 'sent'
  UNION
  SELECT tenant_id, media_content_id, timeline_id, MIN(ts), MIN(ts) + INTERVAL 366 DAY FROM te GROUP BY ALL)""") + """
SELECT j.tenantId, j.matchId, j.timelineId, j.intervalFrom, j.intervalTo, COUNT(*) AS n_events,
       COUNT(*) FILTER (WHERE te.stage = 'rendered') AS n_rendered
FROM mjobs j JOIN te ON te.tenant_id = j.tenantId AND te.media_content_id = j.matchId AND te.timeline_id = j.timelineId
 AND te.ts >= j.intervalFrom AND te.ts < j.intervalTo WHERE te.environment = 'development' GROUP BY ALL""")
def q_jobs_join_events_mixed(spark, sf_dir):
    """A job list that grows with the events: after every overlay sent a minute, an hour or a day, and per timeline a
    year from its first event; all of them overlap."""
    ev = fixture_events(spark, sf_dir)
    ids = [F.col("tenant_id").alias("tenantId"), F.col("media_content_id").alias("matchId"), F.col("timeline_id").alias("timelineId")]
    after = ev.where("stage = 'sent'").select(*ids, F.col("ts").alias("intervalFrom"), F.expr(
        f"ts + make_dt_interval(0, 0, {_MIXED_MINUTES})").alias("intervalTo"))
    year = ev.groupBy(*ids).agg(F.min("ts").alias("intervalFrom")).withColumn("intervalTo", F.expr("intervalFrom + INTERVAL 366 DAY"))
    return JB.jobs_join_events(after.unionByName(year), ev, environment=ENVIRONMENT, counts={
        "n_events": F.lit(True), "n_rendered": F.col("stage") == "rendered"}).select(
        "tenantId", "matchId", "timelineId", "intervalFrom", "intervalTo", "n_events", "n_rendered")


@register("backfill_platform", O.with_(*_BF_CTES, O.platform_cte(src="jbase")) + f"SELECT {O.PLATFORM_COLS} FROM plat")
def q_backfill_platform(spark, sf_dir):
    ev, jobs = _backfill_jobs(spark, sf_dir)
    return M.platform_metrics(JB.jobs_join_events(jobs, ev, environment=ENVIRONMENT))


@register("latency_zero_fill", O.with_(*_BF_CTES, O.latency_cte(src="jbase")) + """SELECT j.timelineId, j.matchId,
  j.tenantId, j.intervalFrom, j.intervalTo, """ + ", ".join(
    f"COALESCE(l.{c}, 0.0) AS {c}" for c in
    [f"{n}_{s}" for n, _ in O.LAT_SERIES for s in ["p50", "p75", "p95", "p99", "avg", "max"]]
    + ["renderDuration_p50", "renderDuration_p95", "renderDuration_p99", "renderDuration_avg"])
    + """ FROM bjobs j LEFT JOIN lat l ON j.tenantId = l.tenantId AND j.matchId = l.matchId
  AND j.timelineId = l.timelineId AND j.intervalFrom = l.intervalFrom AND j.intervalTo = l.intervalTo""")
def q_latency_zero_fill(spark, sf_dir):
    ev, jobs = _backfill_jobs(spark, sf_dir)
    return JB.zero_fill_latency(jobs, M.latency_percentiles(JB.jobs_join_events(jobs, ev, environment=ENVIRONMENT)))


# ------------------------------------------------------------------ store
from pulseboard.operators.predicates import MetricQuery  # noqa: E402
from pulseboard.plans import store as ST  # noqa: E402
from pulseboard.schema import METRIC_META  # noqa: E402

_LAT_FLAT = (["timelineId", "matchId", "tenantId", "intervalFrom", "intervalTo"]
             + [f"{n}_{s}" for n, _ in O.LAT_SERIES for s in ["p50", "p75", "p95", "p99", "avg", "max"]]
             + ["renderDuration_p50", "renderDuration_p95", "renderDuration_p99", "renderDuration_avg"])
_TS_COLS = ["timelineId", "matchId", "tenantId", "metric", "interval", "time", "value", "intervalFrom", "intervalTo"]

# metric type -> (per-job Spark builder, oracle CTEs, oracle per-job relation, columns, double accumulated fields)
_PER_JOB = {
    "platform": (M.platform_metrics, [O.platform_cte()], "plat", [c.strip() for c in O.PLATFORM_COLS.split(",")],
                 {"sent"}),
    "device": (M.device_breakdown, [O.device_cte()], "dev", [c.strip() for c in DEVICE_COLS.split(",")], set()),
    "transport": (M.transport_comparison, [O.transport_cte()], "tr", [c.strip() for c in TRANSPORT_COLS.split(",")],
                  set()),
    "sdk": (M.sdk_versions, [O.sdk_cte()], "sdk", [c.strip() for c in SDK_COLS.split(",")], set()),
    "failure": (M.failure_analysis, [O.failure_cte()], "fail", [c.strip() for c in FAILURE_COLS.split(",")], set()),
    "latency": (M.latency_percentiles, [O.latency_cte()], "lat", _LAT_FLAT, set()),
    "timeseries": (M.timeseries, [O.timeseries_cte(), f"tsl AS ({O.timeseries_long()})"], "tsl", _TS_COLS,
                   {"value"}),
}


def _per_job(spark, sf_dir, t, base=None):
    base = etl_base(spark, sf_dir) if base is None else base
    return _PER_JOB[t][0](base)


def _rollup_oracle(t: str, src_filter: str | None = None) -> tuple[list[str], str]:
    fn, ctes, rel, cols, dbl = _PER_JOB[t]
    meta = METRIC_META[t]
    return ([O.FIXTURE_VIEW, O.grid_base(DAILY), *ctes],
            O.rollup_sql(rel, cols, list(meta.unique), list(meta.accumulate), dbl))


def _match_table(spark, sf_dir, t):
    return ST.match_rollup(_per_job(spark, sf_dir, t), t)


for _t in METRIC_META:
    _ctes, _sql = _rollup_oracle(_t)
    register(f"match_rollup_{_t}", O.with_(*_ctes) + _sql)(
        lambda spark, sf_dir, _tt=_t: _match_table(spark, sf_dir, _tt))


@register("match_rollup_platform_recomputed", O.with_(*_rollup_oracle("platform")[0], "mr AS (" + _rollup_oracle("platform")[1] + ")")
          + f"""SELECT tenantId, matchId, platform, intervalFrom, sent, received, rendered, failed,
  {O.rate('received', 'sent')} AS receiveRate, {O.rate('rendered', 'received')} AS renderRate,
  {O.rate('failed', 'received')} AS failureRate, {O.rate('rendered', 'sent')} AS netSuccessRate FROM mr""")
def q_match_rollup_recomputed(spark, sf_dir):
    from pulseboard.functions.numeric import rate
    t = _match_table(spark, sf_dir, "platform")
    return t.select("tenantId", "matchId", "platform", "intervalFrom", "sent", "received", "rendered", "failed",
                    rate("received", "sent").alias("receiveRate"), rate("rendered", "received").alias("renderRate"),
                    rate("failed", "received").alias("failureRate"), rate("rendered", "sent").alias("netSuccessRate"))


# Match-level metrics over all events of a match (an average or percentile of timelines is not the match's)
for _t in ("device", "transport", "sdk", "latency", "timeseries"):
    _fn, _, _rel, _cols, _ = _PER_JOB[_t]
    _cte = {"device": O.device_cte, "transport": O.transport_cte, "sdk": O.sdk_cte, "latency": O.latency_cte,
            "timeseries": O.timeseries_cte}[_t](src="mbase")
    register(f"match_rollup_{_t}_recomputed",
             O.with_(O.FIXTURE_VIEW, O.grid_base(DAILY), "mbase AS (SELECT * REPLACE ('' AS timelineId) FROM base)", _cte,
                     *([f"tsl AS ({O.timeseries_long()})"] if _t == "timeseries" else []))
             + f"SELECT {', '.join(_cols)} FROM {_rel}")(
        lambda spark, sf_dir, _f=_fn, _c=_cols: _f(match_level(etl_base(spark, sf_dir))).select(*_c))


# Store "as of" 2024-01-20 (events before the cutoff), then a full re-run of every daily job.
STORE_CUTOFF = "2024-01-20T00:00:00Z"
_CUT_SQL = "ts < TIMESTAMP '2024-01-20 00:00:00'"


def _old_new(spark, sf_dir):
    ev = fixture_events(spark, sf_dir)
    old_rows = M.platform_metrics(grid_context(ev.where(F.col("ts") < F.lit("2024-01-20 00:00:00").cast("timestamp")),
                                               DAILY, environment=ENVIRONMENT))
    new_rows = M.platform_metrics(grid_context(ev, DAILY, environment=ENVIRONMENT))
    return old_rows, new_rows


_PCOLS = [c.strip() for c in O.PLATFORM_COLS.split(",")]
_UPSERT_CTES = [O.FIXTURE_VIEW, O.grid_base(DAILY), O.platform_cte(name="pnew"),
                f"obase AS (SELECT * FROM base WHERE {_CUT_SQL})", O.platform_cte(name="pold", src="obase"),
                "oldt AS (" + O.rollup_sql("pold", _PCOLS, list(METRIC_META['platform'].unique),
                                           list(METRIC_META['platform'].accumulate), {"sent"}) + ")",
                "newt AS (" + O.rollup_sql("pnew", _PCOLS, list(METRIC_META['platform'].unique),
                                           list(METRIC_META['platform'].accumulate), {"sent"}) + ")"]


def _upsert_select() -> str:
    key = list(METRIC_META["platform"].unique)
    inc = list(METRIC_META["platform"].accumulate)
    sel = []
    for c in _PCOLS:
        if c in key:
            sel.append(f"COALESCE(n.{c}, o.{c}) AS {c}")
        elif c in inc:
            sel.append(f"COALESCE(o.{c}, 0) + COALESCE(n.{c}, 0) AS {c}")
        else:
            sel.append(f"CASE WHEN n.tenantId IS NOT NULL THEN n.{c} ELSE o.{c} END AS {c}")
    on = " AND ".join(f"o.{k} = n.{k}" for k in key)
    return f"SELECT {', '.join(sel)} FROM oldt o FULL OUTER JOIN newt n ON {on}"


@register("accumulate_upsert", O.with_(*_UPSERT_CTES) + _upsert_select())
def q_accumulate_upsert(spark, sf_dir):
    old_rows, new_rows = _old_new(spark, sf_dir)
    return ST.upsert(ST.match_rollup(old_rows, "platform"), new_rows, "platform")


@register("idempotent_upsert", O.with_(*_UPSERT_CTES) + "SELECT * FROM newt")
def q_idempotent_upsert(spark, sf_dir):
    old_rows, new_rows = _old_new(spark, sf_dir)
    return ST.idempotent_upsert(old_rows, new_rows, "platform")


READ_Q = MetricQuery(tenant_id="tenant-0", start="2024-01-05T00:00:00Z", end="2024-01-25T00:00:00Z")
READ_Q_MATCH = MetricQuery(tenant_id="tenant-1", match_id="match-1", timeline_ids=("tl-7", "tl-13"))
_READ_SQL = ("tenantId = 'tenant-0' AND intervalFrom >= TIMESTAMP '2024-01-05 00:00:00' "
             "AND intervalFrom <= TIMESTAMP '2024-01-25 00:00:00'")
_READ_SQL_M = "tenantId = 'tenant-1' AND matchId = 'match-1' AND timelineId IN ('tl-7', 'tl-13')"


def _stored(spark, sf_dir, t):
    """A store table written from the per-job rows, below the scratch folder."""
    path = f"{_scratch(spark, 'store-read')}/{t}"
    ST.upsert_table(spark, path, _per_job(spark, sf_dir, t), t)
    return path


for _t in METRIC_META:
    _ctes, _sql = _rollup_oracle(_t)
    register(f"read_{_t}", O.with_(*_ctes, f"mt AS ({_sql})") + f"SELECT * FROM mt WHERE {_READ_SQL}")(
        lambda spark, sf_dir, _tt=_t: ST.scan_metric(spark, _stored(spark, sf_dir, _tt), _tt, READ_Q))

_ctes, _sql = _rollup_oracle("platform")
register("read_platform_match", O.with_(*_ctes, f"mt AS ({_sql})") + f"SELECT * FROM mt WHERE {_READ_SQL_M}")(
    lambda spark, sf_dir: ST.scan_metric(spark, _stored(spark, sf_dir, "platform"), "platform", READ_Q_MATCH))


@register("store_upsert_twice", O.with_(*_ctes) + _sql)
def q_store_upsert_twice(spark, sf_dir):
    """The stored platform table after the same run twice."""
    path, rows = _stored(spark, sf_dir, "platform"), _per_job(spark, sf_dir, "platform")
    ST.upsert_table(spark, path, rows, "platform")
    return ST.read_table(spark, path).select(*_PCOLS)


@register("store_rerun_shrunk_job", O.with_(*_ctes, f"mt AS ({_sql})") + f"SELECT * FROM mt WHERE intervalFrom < TIMESTAMP '2024-01-20 00:00:00'")
def q_store_rerun_shrunk_job(spark, sf_dir):
    """The stored table after a rerun of all jobs over events that end earlier: the later jobs' rows and days are gone."""
    path = _stored(spark, sf_dir, "platform")
    base = etl_base(spark, sf_dir)
    jobs = base.select("tenantId", "matchId", "timelineId", "intervalFrom", "intervalTo").distinct()
    rows = M.platform_metrics(base.where(F.col("ts") < F.lit("2024-01-20 00:00:00").cast("timestamp")))
    ST.upsert_table(spark, path, rows, "platform", jobs=jobs)
    return ST.read_table(spark, path).select(*_PCOLS)


_ctes, _sql = _rollup_oracle("timeseries")
register("read_timeseries_metric", O.with_(*_ctes, f"mt AS ({_sql})")
         + f"SELECT * FROM mt WHERE {_READ_SQL} AND metric = 'failed'")(
    lambda spark, sf_dir: ST.scan_metric(spark, _stored(spark, sf_dir, "timeseries"), "timeseries", READ_Q, "failed"))

RETENTION_NOW = "2024-04-15T00:00:00Z"


@register("retention_prune", O.with_(*_ctes, f"mt AS ({_sql})")
          + "SELECT * FROM mt WHERE intervalFrom >= TIMESTAMP '2024-01-16 00:00:00'")
def q_retention_prune(spark, sf_dir):
    """The stored timeseries after a retention run."""
    path = _stored(spark, sf_dir, "timeseries")
    ST.expire_table(spark, path, RETENTION_NOW)
    return ST.read_table(spark, path).select(*_TS_COLS)


# ------------------------------------------------------------------ A16 match funnel
from pulseboard.operators import match_funnel as MF  # noqa: E402


def _etl_events(spark, sf_dir):
    return fixture_events(spark, sf_dir).where(F.col("environment") == "development")


_MF_CTE = """
mq AS (
  SELECT tenant_id AS tenantId, media_content_id AS matchId, timeline_id AS timelineId,
         CAST(SUM(CAST(CASE WHEN stage = 'sent' THEN room_size END AS DECIMAL(38,6))) AS DOUBLE) AS _sent,
         COUNT(*) FILTER (WHERE stage = 'received') AS received,
         COUNT(*) FILTER (WHERE stage = 'rendered') AS rendered,
         COUNT(*) FILTER (WHERE stage = 'render-failed') AS failed,
         COUNT(*) AS doc_count
  FROM te WHERE environment = 'development' AND media_content_id IS NOT NULL AND timeline_id IS NOT NULL
  GROUP BY tenant_id, media_content_id, timeline_id
)"""


@register("match_funnel", O.with_(O.FIXTURE_VIEW, _MF_CTE) + f"""SELECT tenantId, matchId, {O.r2('_sent')} AS sent,
  received, rendered, failed, {O.rate('received', O.r2('_sent'))} AS receiveRate,
  {O.rate('rendered', 'received')} AS renderRate, {O.rate('failed', 'received')} AS failureRate,
  {O.rate('rendered', O.r2('_sent'))} AS netSuccessRate, questionCount
FROM (SELECT tenantId, matchId, CAST(SUM(CAST(_sent AS DECIMAL(38,6))) AS DOUBLE) AS _sent,
             CAST(SUM(received) AS BIGINT) AS received, CAST(SUM(rendered) AS BIGINT) AS rendered,
             CAST(SUM(failed) AS BIGINT) AS failed, CAST(COUNT(*) AS BIGINT) AS questionCount
      FROM mq GROUP BY tenantId, matchId)""")
def q_match_funnel(spark, sf_dir):
    return MF.match_funnel(_etl_events(spark, sf_dir))


@register("match_funnel_questions", O.with_(O.FIXTURE_VIEW, _MF_CTE) + f"""SELECT tenantId, matchId, timelineId,
  {O.r2('_sent')} AS sent, received, rendered, failed, {O.rate('received', O.r2('_sent'))} AS receiveRate,
  {O.rate('rendered', 'received')} AS renderRate
FROM mq""")
def q_match_funnel_questions(spark, sf_dir):
    return MF.match_funnel_questions(_etl_events(spark, sf_dir))


# ------------------------------------------------------------------ streaming (ST1-ST4)
import uuid  # noqa: E402

from pulseboard.session import ensure_checkpoint_dir  # noqa: E402
from pulseboard.sources.events import fixture_event_stream  # noqa: E402
from pulseboard.streaming import sinks as SK  # noqa: E402
from pulseboard.streaming import windowed as SW  # noqa: E402


def _scratch(spark, name: str) -> str:
    """A fresh folder below the session's (shared) checkpoint directory."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@register("stream_platform_hourly", ORACLES["platform_metrics_hourly"])
def q_stream_platform(spark, sf_dir):
    root = _scratch(spark, "stream-platform")
    stream = SW.stream_platform_metrics(fixture_event_stream(spark, sf_dir), minutes=HOURLY, environment=ENVIRONMENT)
    SK.run_available_now(stream, SK.metric_upsert_sink(f"{root}/platform", "platform"), f"{root}/_checkpoint")
    return spark.read.parquet(f"{root}/platform_contrib").select(*[c.strip() for c in O.PLATFORM_COLS.split(",")])


@register("stream_timeseries_hourly_jobs", ORACLES["timeseries_hourly_jobs"])
def q_stream_timeseries(spark, sf_dir):
    root = _scratch(spark, "stream-timeseries")
    stream = SW.stream_timeseries_buckets(fixture_event_stream(spark, sf_dir), job_minutes=HOURLY, environment=ENVIRONMENT)
    SK.run_available_now(stream, SK.buckets_sink(f"{root}/buckets"), f"{root}/_checkpoint")
    return M.timeseries_from_buckets(spark.read.parquet(f"{root}/buckets").drop("intervalDate"))


@register("stream_job_dead_letters", ORACLES["job_dead_letters"])
def q_stream_job_dlq(spark, sf_dir):
    root = _scratch(spark, "stream-jobs")
    JS.fixture_job_messages(fixture_events(spark, sf_dir), JOB_NOW).write.text(f"{root}/messages")
    msgs = spark.readStream.schema("value string").text(f"{root}/messages")
    SK.run_available_now(msgs, SK.job_validation_sink(f"{root}/jobs", f"{root}/dlq", JOB_NOW),
                         f"{root}/_checkpoint", output_mode="append")
    return spark.read.parquet(f"{root}/dlq").select("value", "errorMessage", "failedAt")


# ------------------------------------------------------------------ A18 all metrics in one run
from pulseboard.plans import etl as ETL  # noqa: E402


@register("all_metrics_store", " UNION ALL ".join(
    f"SELECT '{_t}' AS metric, CAST(COUNT(*) AS BIGINT) AS rows FROM ("
    + O.with_(*_rollup_oracle(_t)[0]) + _rollup_oracle(_t)[1] + ")" for _t in METRIC_META))
def q_all_metrics_store(spark, sf_dir):
    """Run all seven metrics into a fresh store (idempotent mode) and report rows per table."""
    root = _scratch(spark, "store")
    ETL.run_all(spark, etl_base(spark, sf_dir), root)
    parts = [spark.read.parquet(f"{root}/{t}").select(F.lit(t).alias("metric")) for t in METRIC_META]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("metric").agg(F.count(F.lit(1)).alias("rows"))


_STORED_KEYS = {t: [c for c in m.unique if c not in ("tenantId", "matchId", "intervalFrom", "time")] for t, m in METRIC_META.items()}
_STORED_VALUES = {
    "platform": "sent received rendered failed receiveRate renderRate failureRate netSuccessRate avgRenderMs",
    "device": "received rendered failed renderRate avgRenderMs", "transport": "count renderRate avgRenderMs p95RenderMs",
    "sdk": "count renderRate avgRenderMs", "failure": "count percentOfFailed", "timeseries": "value",
    "latency": " ".join([f"{s}.{f}" for s in ("receive", "render", "ack") for f in ("p50", "p75", "p95", "p99", "avg", "max")]
                        + [f"renderDuration.{f}" for f in ("p50", "p95", "p99", "avg")]),
}
_SORT_TIME = {t: "time" if t == "timeseries" else "intervalFrom" for t in METRIC_META}


def _stored_values_sql(t: str) -> str:
    ctes, sql = _rollup_oracle(t)
    key = " || '|' || ".join(["''", *_STORED_KEYS[t]])
    fields = _STORED_VALUES[t].split()
    cells = ", ".join(f"CAST({f.replace('.', '_')} AS DOUBLE)" for f in fields)
    return (f"SELECT '{t}' AS metric, tenantId, matchId, timelineId, {_SORT_TIME[t]} AS at, {key} AS key, unnest([{', '.join(repr(f) for f in fields)}]) AS field, "
            f"unnest([{cells}]) AS value FROM ({O.with_(*ctes)}{sql})")


@register("all_metrics_values", " UNION ALL ".join(_stored_values_sql(_t) for _t in METRIC_META))
def q_all_metrics_values(spark, sf_dir):
    """Every number of the seven tables that one run writes into a fresh store, in long form."""
    root = _scratch(spark, "store-values")
    ETL.run_all(spark, etl_base(spark, sf_dir), root)
    parts = []
    for t in METRIC_META:
        key = F.concat(F.lit(""), *[F.concat(F.lit("|"), F.col(k)) for k in _STORED_KEYS[t]])
        cells = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("double").alias("value")) for f in _STORED_VALUES[t].split()])
        parts.append(ST.read_table(spark, f"{root}/{t}").select(
            F.lit(t).alias("metric"), "tenantId", "matchId", "timelineId", F.col(_SORT_TIME[t]).alias("at"), key.alias("key"), F.inline(cells)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


from pulseboard.operators import latency_merge as LM  # noqa: E402

_MERGED_SQL = O.with_(O.FIXTURE_VIEW, O.grid_base(DAILY), "mbase AS (SELECT * REPLACE ('' AS timelineId) FROM base)", O.latency_cte(src="mbase"))


@register("match_latency_merged", _MERGED_SQL + "SELECT tenantId, matchId, intervalFrom, intervalTo, receive_avg, receive_max, render_avg, render_max, ack_avg, ack_max, "
          + ", ".join(f"true AS {s}_p{p}_close" for s in ("receive", "render", "ack") for p in (50, 75, 95, 99)) + " FROM lat")
def q_match_latency_merged(spark, sf_dir):
    """Latency of matches merged from the stored histograms of their jobs.  Averages and maxima are exact; of each percentile the
    row tells whether it lies within the stated error of the one recomputed over all events of the match."""
    base, keys = etl_base(spark, sf_dir), ["tenantId", "matchId", "intervalFrom", "intervalTo"]
    path = _scratch(spark, "latency-histograms")
    LM.latency_histograms(base).write.parquet(path)
    merged = LM.merge_latency(spark.read.parquet(path))
    points = [f"{s}_p{p}" for s in M.LATENCY_SERIES for p in (50, 75, 95, 99)]
    exact = M.latency_percentiles(match_level(base)).select(*keys, *[F.col(c).alias(f"exact_{c}") for c in points])
    close = [(F.abs(F.col(c) - F.col(f"exact_{c}")) <= LM.ERROR * (F.abs(f"exact_{c}") + 1) + 0.01).alias(f"{c}_close") for c in points]
    return merged.join(exact, keys).select(*keys, *[f"{s}_{x}" for s in M.LATENCY_SERIES for x in ("avg", "max")], *close)


# ------------------------------------------------------------------ exact percentiles under their earlier names (A8/A10): there is one path
register("latency_percentiles_skew_safe", ORACLES["latency_percentiles"])(
    lambda spark, sf_dir: M.latency_percentiles(etl_base(spark, sf_dir)))
register("realtime_latency_skew_safe", ORACLES["realtime_latency"])(
    lambda spark, sf_dir: _rt(spark, sf_dir, RT_MATCH).latency())
register("transport_comparison_skew_safe", ORACLES["transport_comparison"])(
    lambda spark, sf_dir: M.transport_comparison(etl_base(spark, sf_dir)))

RT_ALL = RealtimeQuery()
_RT_ALL_SQL = O.rt_base("true")


@register("realtime_funnel_all", O.with_(O.FIXTURE_VIEW, _RT_ALL_SQL, O.platform_cte(src="rtb")) + O.rt_funnel_select())
def q_rt_funnel_all(spark, sf_dir):
    """The funnel of every tenant over its whole history (no request filter at all)."""
    return _rt(spark, sf_dir, RT_ALL).funnel()


# ------------------------------------------------------------------ job consumer stream (end to end)
from pulseboard.streaming.consumer import job_consumer_sink  # noqa: E402


def _bf_match_table_sql() -> str:
    meta = METRIC_META["platform"]
    return (O.with_(*_BF_CTES, O.platform_cte(src="jbase"))
            + O.rollup_sql("plat", _PCOLS, list(meta.unique), list(meta.accumulate), {"sent"}))


@register("stream_job_consumer_platform", _bf_match_table_sql())
def q_stream_job_consumer(spark, sf_dir):
    """Backfill job messages as a stream -> validation -> range join -> seven metrics -> store;
    returns the stored match-level platform table."""
    root = _scratch(spark, "stream-consumer")
    ev = fixture_events(spark, sf_dir)
    req = JS.fixture_backfill_requests(JS.fixture_targets(ev))
    jobs = JB.expand_backfill(req, caller_tenant_col="callerTenant", correlation_id="correlationKey")
    JB.encode_jobs(jobs).select("value").write.text(f"{root}/messages")
    msgs = spark.readStream.schema("value string").text(f"{root}/messages")
    sink = job_consumer_sink(ev, f"{root}/store", f"{root}/dlq", lambda batch_id: JOB_NOW, environment="development")
    SK.run_available_now(msgs, sink, f"{root}/_checkpoint", output_mode="append")
    return spark.read.parquet(f"{root}/store/platform").select(*_PCOLS)

# the same percentiles over events dealt out anew: hot and ordinary groups take one plan, and no row order matters
register("latency_percentiles_hot_split", ORACLES["latency_percentiles"])(
    lambda spark, sf_dir: M.latency_percentiles(etl_base(spark, sf_dir).repartition(40)))
register("transport_comparison_hot_split", ORACLES["transport_comparison"])(
    lambda spark, sf_dir: M.transport_comparison(etl_base(spark, sf_dir).repartition(40)))


def _stream_top_sql(n: int) -> str:
    meta = METRIC_META["platform"]
    return (O.with_(O.FIXTURE_VIEW, O.grid_base(HOURLY), O.platform_cte(top_n=n))
            + O.rollup_sql("plat", _PCOLS, list(meta.unique), list(meta.accumulate), {"sent"}))


STREAM_TOP_N = 2


@register("stream_top_platforms_match", _stream_top_sql(STREAM_TOP_N))
def q_stream_top_platforms(spark, sf_dir):
    """Streamed platform buckets -> sink keeps all buckets, applies the per-job top-N, derives the match table."""
    root = _scratch(spark, "stream-top")
    stream = SW.stream_platform_metrics(fixture_event_stream(spark, sf_dir), minutes=HOURLY, environment=ENVIRONMENT, keep_doc_count=True)
    SK.run_available_now(stream, SK.metric_upsert_sink(f"{root}/platform", "platform",
                                                       truncate=SW.platform_top_n(STREAM_TOP_N)),
                         f"{root}/_checkpoint")
    return spark.read.parquet(f"{root}/platform").select(*_PCOLS)


# ------------------------------------------------------------------ late and repeated events (ST1, ST2, K2)
from pulseboard.plans import etl as _ETL  # noqa: E402
from pulseboard.sources.events import FLAT_SCHEMA  # noqa: E402
from pulseboard.streaming import late as LT  # noqa: E402

ARRIVAL_CUTS = ("2024-01-11", "2024-01-21")


def arrivals(ev: DataFrame) -> list[DataFrame]:
    """The events in three deliveries by time; every twentieth of the first comes with the last, every 25th event comes twice."""
    first, second = (F.col("ts") < F.lit(f"{d} 00:00:00").cast("timestamp") for d in ARRIVAL_CUTS)
    late, again = F.col("event_id") % 20 == 0, F.col("event_id") % 25 == 0
    third = ev.where(~second)
    return [ev.where(first & ~late).unionByName(ev.where(first & ~late & again)), ev.where(~first & second),
            third.unionByName(ev.where(first & late)).unionByName(third.where(again))]


@register("stream_late_and_repeated_events", ORACLES["platform_metrics_hourly"])
def q_stream_late_events(spark, sf_dir):
    """Three deliveries with a restart of both streams after each; what came late is worked off as backfill requests.  Equals
    the batch result."""
    root = _scratch(spark, "stream-late")
    seen = None
    for n, delivery in enumerate(arrivals(fixture_events(spark, sf_dir))):
        delivery.write.parquet(f"{root}/events/delivery={n}")
        seen = spark.readStream.schema(FLAT_SCHEMA).parquet(f"{root}/events/*")
        metrics = SW.stream_platform_metrics(LT.drop_repeats(seen), minutes=HOURLY, environment=ENVIRONMENT, watermark=None)
        SK.run_available_now(metrics, SK.metric_upsert_sink(f"{root}/store/platform", "platform"), f"{root}/_metrics")
        SK.run_available_now(seen, LT.late_event_sink(f"{root}/requests", environment=ENVIRONMENT, reads_ahead=False),
                             f"{root}/_late", output_mode="append")
    archive = LT.drop_repeats(spark.read.schema(FLAT_SCHEMA).parquet(f"{root}/events/*"))
    _ETL.backfill(spark, archive, LT.late_requests(spark, f"{root}/requests"), f"{root}/store", environment=ENVIRONMENT,
                  now=JOB_NOW, registry={"platform": M.platform_metrics})
    return spark.read.parquet(f"{root}/store/platform_contrib").select(*_PCOLS)

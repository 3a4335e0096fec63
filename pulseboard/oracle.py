"""DuckDB oracle SQL for the registered queries (the differential-test side).

Every statement starts from the same fixture view ``te`` (the tracking-event
mapping of the driver's ``events`` table) written independently in SQL, so a
mistake in the Spark adapter shows up as a mismatch.  Rounding, exact averages
and percentiles follow the same documented semantics as the Spark side:
``floor(x*100+0.5)/100``, DECIMAL(38,6) sums, ``quantile_cont``.
"""

from __future__ import annotations

# ----------------------------------------------------------------- building blocks
FIXTURE_VIEW = """
te AS (
  SELECT
    event_id,
    CAST(ts AS TIMESTAMP) AS ts,
    'tl-' || CAST(user_id % 30 AS VARCHAR) AS timeline_id,
    'tenant-' || CAST(user_id % 3 AS VARCHAR) AS tenant_id,
    'match-' || CAST(user_id % 6 AS VARCHAR) AS media_content_id,
    CASE WHEN event_id % 10 = 0 THEN 'production' ELSE 'development' END AS environment,
    CASE event_type WHEN 'signup' THEN 'sent' WHEN 'view' THEN 'received'
         WHEN 'click' THEN 'rendered' WHEN 'error' THEN 'render-failed'
         WHEN 'purchase' THEN 'ack' END AS stage,
    CASE CAST(json_extract_string(props, '$.k') AS INTEGER) % 5
         WHEN 0 THEN 'web' WHEN 1 THEN 'ios' WHEN 2 THEN 'android' WHEN 3 THEN 'smarttv' END AS platform,
    CASE event_id % 4 WHEN 0 THEN 'Chrome' WHEN 1 THEN 'Firefox' WHEN 2 THEN 'Safari' END AS browser,
    CASE event_id % 5 WHEN 0 THEN 'Windows' WHEN 1 THEN 'macOS' WHEN 2 THEN 'Linux'
         WHEN 3 THEN 'Android' END AS client_os,
    CASE event_id % 3 WHEN 0 THEN 'Desktop' WHEN 1 THEN 'Mobile' ELSE 'Tablet' END AS device_class,
    CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 3 = 0 THEN 'longPolling'
         ELSE 'wsInteractive' END AS transport_mode,
    CASE WHEN event_id % 13 = 0 THEN NULL
         ELSE 'v2.' || CAST(event_id % 7 AS VARCHAR) || '.0' END AS sdk_version,
    CASE WHEN event_type = 'error' AND event_id % 9 <> 0 THEN
         CASE event_id % 3 WHEN 0 THEN 'timeout' WHEN 1 THEN 'network' ELSE 'validation' END
    END AS failure_reason,
    CASE WHEN event_type = 'error' AND event_id % 8 <> 0 THEN
         CASE event_id % 4 WHEN 0 THEN 'load-overlay' WHEN 1 THEN 'render-overlay'
              WHEN 2 THEN 'ack-event' ELSE 'schema-check' END
    END AS failure_step,
    CASE WHEN event_type = 'signup' THEN CAST(10 + event_id % 90 AS DOUBLE) END AS room_size,
    CASE WHEN event_type IN ('click', 'error') THEN value END AS render_duration_ms,
    CASE WHEN event_type = 'view' THEN value END AS receive_latency_ms,
    CASE WHEN event_type = 'purchase' THEN value END AS ack_latency_ms
  FROM events
)"""

CTX = "tenantId, matchId, timelineId, intervalFrom, intervalTo"
IDS = "timelineId, matchId, tenantId"


def r2(x: str) -> str:
    return (f"(CASE WHEN ({x}) IS NULL OR isnan(CAST(({x}) AS DOUBLE)) OR isinf(CAST(({x}) AS DOUBLE)) "
            f"THEN 0.0 ELSE floor(CAST(({x}) AS DOUBLE) * 100 + 0.5) / 100 END)")


def rate(n: str, d: str) -> str:
    return f"(CASE WHEN CAST(({d}) AS DOUBLE) > 0 THEN {r2(f'CAST(({n}) AS DOUBLE) / CAST(({d}) AS DOUBLE) * 100')} ELSE 0.0 END)"


def calc_rate(n: str, d: str) -> str:
    return (f"(CASE WHEN CAST(({d}) AS DOUBLE) > 0 THEN floor(CAST(({n}) AS DOUBLE) / CAST(({d}) AS DOUBLE) "
            f"* 10000 + 0.5) / 100 ELSE 0.0 END)")


def xavg(x: str) -> str:
    return (f"(CASE WHEN COUNT({x}) > 0 THEN CAST(SUM(CAST({x} AS DECIMAL(38,6))) AS DOUBLE) "
            f"/ COUNT({x}) END)")


def xsum(x: str) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(38,6))) AS DOUBLE)"


def sorted_list(x: str) -> str:
    """Sorted non-null values of a group (oracle side of the exact percentile)."""
    return f"list_sort(list({x}) FILTER (WHERE ({x}) IS NOT NULL))"


def pctl_from_list(lst: str, p: float) -> str:
    """Linear-interpolated percentile written the way Spark's ``percentile`` evaluates it:
    pos = (n-1)*p; value = (ceil(pos)-pos)*v[floor] + (pos-floor(pos))*v[ceil]."""
    n = f"len({lst})"
    pos = f"(CAST({n} - 1 AS DOUBLE) * CAST({p!r} AS DOUBLE))"
    lo, hi = f"CAST(floor({pos}) AS BIGINT)", f"CAST(ceil({pos}) AS BIGINT)"
    lov, hiv = f"{lst}[{lo} + 1]", f"{lst}[{hi} + 1]"
    return (f"(CASE WHEN {n} = 0 THEN NULL WHEN {lo} = {hi} OR {lov} = {hiv} THEN {lov} "
            f"ELSE (CAST({hi} AS DOUBLE) - {pos}) * {lov} + ({pos} - CAST({lo} AS DOUBLE)) * {hiv} END)")


def unknown(c: str) -> str:
    return f"COALESCE(NULLIF(CAST({c} AS VARCHAR), ''), 'unknown')"


def ts_micros(expr_us: str) -> str:
    return f"make_timestamp({expr_us})"


def grid_base(minutes: float = 1440, environment: str | None = "development") -> str:
    step = int(round(minutes * 60_000_000))
    env = f"AND environment = '{environment}'" if environment is not None else ""
    return f"""
base AS (
  SELECT tenant_id AS tenantId, media_content_id AS matchId, timeline_id AS timelineId,
         {ts_micros(f'(epoch_us(ts) // {step}) * {step}')} AS intervalFrom,
         {ts_micros(f'(epoch_us(ts) // {step}) * {step} + {step}')} AS intervalTo,
         te.*
  FROM te
  WHERE tenant_id IS NOT NULL AND tenant_id <> '' AND media_content_id IS NOT NULL
    AND media_content_id <> '' AND timeline_id IS NOT NULL AND timeline_id <> ''
    AND ts IS NOT NULL {env}
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


# ----------------------------------------------------------------- metric CTEs
def platform_cte(name: str = "plat", src: str = "base", top_n: int | None = None,
                 ctx: str = CTX) -> str:
    lim = f"WHERE rk <= {top_n}" if top_n else ""
    return f"""
{name}_agg AS (
  SELECT {ctx}, {unknown('platform')} AS platform,
         {xsum("CASE WHEN stage = 'sent' THEN room_size END")} AS sent_raw,
         COUNT(*) FILTER (WHERE stage = 'received') AS received_raw,
         COUNT(*) FILTER (WHERE stage = 'rendered') AS rendered_raw,
         COUNT(*) FILTER (WHERE stage = 'render-failed') AS failed_raw,
         {xavg("CASE WHEN stage = 'rendered' THEN render_duration_ms END")} AS avg_render_raw,
         COUNT(*) AS doc_count
  FROM {src} GROUP BY {ctx}, {unknown('platform')}
),
{name}_top AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY {ctx} ORDER BY doc_count DESC, platform ASC) AS rk
    FROM {name}_agg) {lim}
),
{name} AS (
  SELECT {IDS}, platform, {r2('sent_raw')} AS sent,
         received_raw AS received, rendered_raw AS rendered, failed_raw AS failed,
         {rate('received_raw', r2('sent_raw'))} AS receiveRate,
         {rate('rendered_raw', 'received_raw')} AS renderRate,
         {rate('failed_raw', 'received_raw')} AS failureRate,
         {rate('rendered_raw', r2('sent_raw'))} AS netSuccessRate,
         {r2('avg_render_raw')} AS avgRenderMs,
         intervalFrom, intervalTo,
         sent_raw, received_raw, rendered_raw, failed_raw, avg_render_raw, doc_count
  FROM {name}_top
)"""


PLATFORM_COLS = ("timelineId, matchId, tenantId, platform, sent, received, rendered, failed, "
                 "receiveRate, renderRate, failureRate, netSuccessRate, avgRenderMs, intervalFrom, intervalTo")

DEVICE_DIMS = [("browser", "browser"), ("os", "client_os"), ("deviceClass", "device_class")]


def device_cte(name: str = "dev", src: str = "base", dims=None, top_n: int | None = None) -> str:
    dims = DEVICE_DIMS if dims is None else dims
    unions = "\n    UNION ALL\n    ".join(
        f"SELECT {CTX}, stage, render_duration_ms, '{d}' AS dimension, {unknown(c)} AS bucketKey FROM {src}"
        for d, c in dims)
    lim = f"WHERE rk <= {top_n}" if top_n else ""
    return f"""
{name}_u AS (
    {unions}
),
{name}_agg AS (
  SELECT {CTX}, dimension, bucketKey,
         COUNT(*) FILTER (WHERE stage = 'received') AS received,
         COUNT(*) FILTER (WHERE stage = 'rendered') AS rendered,
         COUNT(*) FILTER (WHERE stage = 'render-failed') AS failed,
         {xavg("CASE WHEN stage = 'rendered' THEN render_duration_ms END")} AS avg_render_raw,
         COUNT(*) AS doc_count
  FROM {name}_u GROUP BY {CTX}, dimension, bucketKey
),
{name} AS (
  SELECT {IDS}, dimension, bucketKey, received, rendered, failed,
         {rate('rendered', 'received')} AS renderRate, {r2('avg_render_raw')} AS avgRenderMs,
         intervalFrom, intervalTo
  FROM (SELECT *, row_number() OVER (PARTITION BY {CTX}, dimension ORDER BY doc_count DESC, bucketKey ASC) AS rk
        FROM {name}_agg) {lim}
)"""


def transport_cte(name: str = "tr", src: str = "base", top_n: int | None = None) -> str:
    lim = f"WHERE rk <= {top_n}" if top_n else ""
    return f"""
{name}_agg AS (
  SELECT {CTX}, {unknown('transport_mode')} AS transportMode, COUNT(*) AS count,
         COUNT(*) FILTER (WHERE stage = 'received') AS _received,
         COUNT(*) FILTER (WHERE stage = 'rendered') AS _rendered,
         {xavg("CASE WHEN stage = 'rendered' THEN render_duration_ms END")} AS _avg,
         {sorted_list("CASE WHEN stage = 'rendered' THEN render_duration_ms END")} AS _lst
  FROM {src} GROUP BY {CTX}, {unknown('transport_mode')}
),
{name} AS (
  SELECT {IDS}, transportMode, count, {rate('_rendered', '_received')} AS renderRate,
         {r2('_avg')} AS avgRenderMs, {r2(pctl_from_list('_lst', 0.95))} AS p95RenderMs, intervalFrom, intervalTo
  FROM (SELECT *, row_number() OVER (PARTITION BY {CTX} ORDER BY count DESC, transportMode ASC) AS rk
        FROM {name}_agg) {lim}
)"""


def sdk_cte(name: str = "sdk", src: str = "base", top_n: int | None = None) -> str:
    lim = f"WHERE rk <= {top_n}" if top_n else ""
    return f"""
{name}_agg AS (
  SELECT {CTX}, {unknown('sdk_version')} AS sdkVersion, COUNT(*) AS count,
         COUNT(*) FILTER (WHERE stage = 'received') AS _received,
         COUNT(*) FILTER (WHERE stage = 'rendered') AS _rendered,
         {xavg("CASE WHEN stage = 'rendered' THEN render_duration_ms END")} AS _avg
  FROM {src} GROUP BY {CTX}, {unknown('sdk_version')}
),
{name} AS (
  SELECT {IDS}, sdkVersion, count, {rate('_rendered', '_received')} AS renderRate,
         {r2('_avg')} AS avgRenderMs, intervalFrom, intervalTo
  FROM (SELECT *, row_number() OVER (PARTITION BY {CTX} ORDER BY count DESC, sdkVersion ASC) AS rk
        FROM {name}_agg) {lim}
)"""


def failure_cte(name: str = "fail", src: str = "base", top_reasons: int | None = None,
                top_steps: int | None = None) -> str:
    rlim = f"AND reason_rk <= {top_reasons}" if top_reasons else ""
    slim = f"WHERE step_rk <= {top_steps}" if top_steps else ""
    norm_r = "CASE WHEN failure_reason = '' THEN 'unknown' ELSE failure_reason END"
    norm_s = "CASE WHEN failure_step = '' THEN 'unknown' ELSE failure_step END"
    return f"""
{name}_steps AS (
  SELECT {CTX}, {norm_r} AS failureReason, {norm_s} AS failureStep, COUNT(*) AS count
  FROM {src} WHERE failure_reason IS NOT NULL
  GROUP BY {CTX}, {norm_r}, {norm_s}
),
{name}_rn AS (
  SELECT *, SUM(count) OVER (PARTITION BY {CTX}, failureReason) AS reason_n FROM {name}_steps
),
{name}_rk AS (
  SELECT *, dense_rank() OVER (PARTITION BY {CTX} ORDER BY reason_n DESC, failureReason ASC) AS reason_rk
  FROM {name}_rn
),
{name}_kept AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY {CTX}, failureReason ORDER BY count DESC, failureStep ASC) AS step_rk
    FROM {name}_rk WHERE failureStep IS NOT NULL {rlim}) {slim}
),
{name} AS (
  SELECT {IDS}, failureReason, failureStep, count,
         CASE WHEN SUM(count) OVER (PARTITION BY {CTX}) > 0
              THEN {r2(f'count / SUM(count) OVER (PARTITION BY {CTX}) * 100')} ELSE 0.0 END AS percentOfFailed,
         intervalFrom, intervalTo
  FROM {name}_kept
)"""


LAT_SERIES = [("receive", "receive_latency_ms"), ("render", "render_duration_ms"), ("ack", "ack_latency_ms")]
LAT_P = [50, 75, 95, 99]


def latency_list_cols() -> str:
    parts = []
    for name, col in LAT_SERIES:
        parts.append(f"{sorted_list(col)} AS {name}_lst")
        parts.append(f"{xavg(col)} AS {name}_avg_raw")
        parts.append(f"MAX({col}) AS {name}_max_raw")
    return ",\n         ".join(parts)


def latency_pct_cols() -> str:
    parts = []
    for name, _ in LAT_SERIES:
        for p in LAT_P:
            parts.append(f"{pctl_from_list(f'{name}_lst', p / 100)} AS {name}_p{p}_raw")
    return ",\n         ".join(parts)


def latency_flat_cols() -> str:
    parts = []
    for name, _ in LAT_SERIES:
        for p in LAT_P:
            parts.append(f"{r2(f'{name}_p{p}_raw')} AS {name}_p{p}")
        parts.append(f"{r2(f'{name}_avg_raw')} AS {name}_avg")
        parts.append(f"{r2(f'{name}_max_raw')} AS {name}_max")
    for p in (50, 95, 99):
        parts.append(f"{r2(f'render_p{p}_raw')} AS renderDuration_p{p}")
    parts.append(f"{r2('render_avg_raw')} AS renderDuration_avg")
    return ",\n         ".join(parts)


def latency_cte(name: str = "lat", src: str = "base") -> str:
    return f"""
{name}_lists AS (
  SELECT {CTX},
         {latency_list_cols()}
  FROM {src} GROUP BY {CTX}
),
{name}_raw AS (
  SELECT *, {latency_pct_cols()} FROM {name}_lists
),
{name} AS (
  SELECT {IDS}, intervalFrom, intervalTo,
         {latency_flat_cols()}
  FROM {name}_raw
)"""


def timeseries_cte(name: str = "tsr", src: str = "base", interval: str = "5m") -> str:
    from pulseboard.functions.time import parse_interval
    step = parse_interval(interval)
    return f"""
{name}_agg AS (
  SELECT {CTX}, (epoch_us(ts) // {step}) * {step} AS b,
         {xsum('room_size')} AS _sent,
         COUNT(*) FILTER (WHERE stage = 'received') AS _received,
         COUNT(*) FILTER (WHERE stage = 'rendered') AS _rendered,
         COUNT(*) FILTER (WHERE stage = 'render-failed') AS _failed,
         {xavg('render_duration_ms')} AS _avg
  FROM {src} GROUP BY {CTX}, (epoch_us(ts) // {step}) * {step}
),
{name}_span AS (
  SELECT {CTX}, MIN(b) AS lo, MAX(b) AS hi FROM {name}_agg GROUP BY {CTX}
),
{name}_spine AS (
  SELECT {CTX}, UNNEST(generate_series(lo, hi, {step})) AS b FROM {name}_span
),
{name}_wide AS (
  SELECT s.timelineId, s.matchId, s.tenantId, '{interval}' AS interval, make_timestamp(s.b) AS time,
         {r2('COALESCE(a._sent, 0.0)')} AS sent,
         CAST(COALESCE(a._received, 0) AS DOUBLE) AS received,
         CAST(COALESCE(a._rendered, 0) AS DOUBLE) AS rendered,
         CAST(COALESCE(a._failed, 0) AS DOUBLE) AS failed,
         {r2('a._avg')} AS avgRenderMs,
         s.intervalFrom, s.intervalTo
  FROM {name}_spine s LEFT JOIN {name}_agg a
    ON a.tenantId = s.tenantId AND a.matchId = s.matchId AND a.timelineId = s.timelineId
   AND a.intervalFrom = s.intervalFrom AND a.intervalTo = s.intervalTo AND a.b = s.b
)"""


def timeseries_long(wide: str = "tsr_wide", metrics=None) -> str:
    metrics = ["sent", "received", "rendered", "failed", "avgRenderMs"] if metrics is None else metrics
    return "\nUNION ALL\n".join(
        f"SELECT {IDS}, '{m}' AS metric, interval, time, {m} AS value, intervalFrom, intervalTo FROM {wide}"
        for m in metrics)


def rt_base(where: str, match_id: str = "", timeline_id: str = "", start: str = "1970-01-01 00:00:00",
            end: str = "2024-02-01 00:00:00") -> str:
    """Realtime request context: tenant from the event, literal ids and interval."""
    return f"""
rtb AS (
  SELECT tenant_id AS tenantId, '{match_id}' AS matchId, '{timeline_id}' AS timelineId,
         TIMESTAMP '{start}' AS intervalFrom, TIMESTAMP '{end}' AS intervalTo, te.*
  FROM te WHERE tenant_id IS NOT NULL AND {where}
)"""


def rt_funnel_select(src: str = "plat") -> str:
    return f"""
SELECT tenantId, sent, received, rendered, failed,
       {calc_rate('received', 'sent')} AS receiveRate, {calc_rate('rendered', 'received')} AS renderRate,
       {calc_rate('failed', 'received')} AS failureRate, {calc_rate('rendered', 'sent')} AS netSuccessRate
FROM (SELECT tenantId, CAST(SUM(CAST(sent AS DECIMAL(38,2))) AS DOUBLE) AS sent,
             CAST(SUM(received) AS BIGINT) AS received, CAST(SUM(rendered) AS BIGINT) AS rendered,
             CAST(SUM(failed) AS BIGINT) AS failed
      FROM {src} GROUP BY tenantId)"""


# ----------------------------------------------------------------- job-side oracle CTEs
def job_inputs(now_iso: str = "2024-01-15T10:30:00.000Z") -> str:
    """targets, tenants, active targets, scheduled jobs, backfill requests, messages."""
    head = ("'{\"tenantId\":\"' || tenantId || '\",\"matchId\":\"' || matchId || '\",\"timelineId\":\"' "
            "|| timelineIds[1] || '\"'")
    variants = [
        f"{head} || ',\"timeRangeMinutes\":0}}'",
        "'{\"tenantId\":7,\"matchId\":\"' || matchId || '\",\"timelineId\":\"' || timelineIds[1] || '\",\"timeRangeMinutes\":60}'",
        f"{head} || ',\"timeRangeMinutes\":60'",
        f"{head} || ',\"timeRangeMinutes\":5,\"intervalFrom\":\"not-a-date\",\"intervalTo\":\"2024-01-02T00:00:00.000Z\"}}'",
        f"{head} || ',\"timeRangeMinutes\":5,\"intervalFrom\":\"2024-01-05T00:00:00.000Z\",\"intervalTo\":\"2024-01-04T00:00:00.000Z\"}}'",
        f"{head} || ',\"timeRangeMinutes\":5,\"intervalFrom\":\"2024-01-05T00:00:00.000Z\"}}'",
        f"{head} || ',\"timeRangeMinutes\":7.5,\"retryCount\":2,\"origin\":\"backfill\"}}'",
    ]
    defects = "\n  UNION ALL ".join(f"SELECT {v} AS value FROM targets" for v in variants)
    return f"""
targets AS (
  SELECT tenant_id AS tenantId, media_content_id AS matchId, list_sort(list(DISTINCT timeline_id)) AS timelineIds,
         (CAST(regexp_extract(media_content_id, '(\\d+)$', 1) AS INTEGER) % 5) <> 4 AS enabled
  FROM te WHERE tenant_id IS NOT NULL AND media_content_id IS NOT NULL AND timeline_id IS NOT NULL
  GROUP BY tenant_id, media_content_id
),
tenants AS (
  SELECT DISTINCT tenant_id AS name, CASE WHEN tenant_id = 'tenant-2' THEN 'INACTIVE' ELSE 'ACTIVE' END AS status
  FROM te WHERE tenant_id IS NOT NULL
),
active_targets AS (
  SELECT * FROM targets WHERE enabled AND tenantId IN (SELECT name FROM tenants WHERE status = 'ACTIVE')
),
sched AS (
  SELECT tenantId, matchId, UNNEST(timelineIds) AS timelineId, CAST(60 AS DOUBLE) AS timeRangeMinutes,
         CAST(0 AS BIGINT) AS retryCount, 'scheduled' AS origin, '{now_iso}' AS scheduledAt
  FROM active_targets
),
requests AS (
  SELECT tenantId, matchId, timelineIds, w.f AS intervalFrom, w.t AS intervalTo,
         CASE WHEN matchId = 'match-5' THEN 'tenant-0' ELSE tenantId END AS callerTenant,
         md5(tenantId || '|' || matchId || '|' || w.f || '|' || w.t) AS correlationKey
  FROM targets, (VALUES ('2024-01-06T00:00:00.000Z', '2024-01-13T00:00:00.000Z'),
                        ('2024-01-10T00:00:00.000Z', '2024-01-20T00:00:00.000Z'),
                        ('2024-03-01T00:00:00.000Z', '2024-03-02T00:00:00.000Z')) AS w(f, t)
),
backfill AS (
  SELECT tenantId, matchId, UNNEST(timelineIds) AS timelineId, CAST(5 AS DOUBLE) AS timeRangeMinutes,
         intervalFrom, intervalTo, CAST(0 AS BIGINT) AS retryCount, 'backfill' AS origin,
         correlationKey AS correlationId
  FROM requests WHERE tenantId = callerTenant
),
msgs AS (
  SELECT '{{"version":1,"jobType":"extract-transform-load-metrics","tenantId":"' || tenantId || '","matchId":"'
         || matchId || '","timelineId":"' || timelineId || '","timeRangeMinutes":60.0,"retryCount":0,'
         || '"origin":"scheduled","scheduledAt":"{now_iso}"}}' AS value FROM sched
  UNION ALL {defects}
)"""


def validate_cte(src: str = "msgs", name: str = "val") -> str:
    # DuckDB may evaluate JSON functions on every row regardless of CASE guards,
    # so unparseable values are replaced by '{}' before any JSON function runs.
    ok = "ok"

    def jt(path):
        return f"json_type(jv, '{path}')"

    def js(path):
        return f"json_extract_string(jv, '{path}')"

    def sok(k):
        return f"(COALESCE({jt('$.' + k)} = 'VARCHAR', false) AND COALESCE(length({js('$.' + k)}), 0) > 0)"

    rng = f"TRY_CAST({js('$.timeRangeMinutes')} AS DOUBLE)"
    rng_ok = (f"(COALESCE({jt('$.timeRangeMinutes')} IN ('UBIGINT', 'BIGINT', 'DOUBLE'), false) AND {rng} IS NOT NULL "
              f"AND NOT isnan({rng}) AND NOT isinf({rng}) AND {rng} > 0)")
    f_s, t_s = js("$.intervalFrom"), js("$.intervalTo")
    f_t = f"CAST(TRY_CAST({f_s} AS TIMESTAMPTZ) AS TIMESTAMP)"
    t_t = f"CAST(TRY_CAST({t_s} AS TIMESTAMPTZ) AS TIMESTAMP)"
    explicit = f"({f_s} IS NOT NULL OR {t_s} IS NOT NULL)"
    err = f"""CASE WHEN NOT {ok} THEN 'Unparseable job message'
         WHEN NOT ({sok('tenantId')} AND {sok('matchId')} AND {sok('timelineId')} AND {rng_ok})
           THEN 'Invalid timeline payload: missing tenantId, matchId, timelineId, or timeRangeMinutes'
         WHEN {f_s} IS NOT NULL AND {f_t} IS NULL THEN 'Missing or invalid job field: intervalFrom'
         WHEN {t_s} IS NOT NULL AND {t_t} IS NULL THEN 'Missing or invalid job field: intervalTo'
         WHEN {explicit} AND ({f_t} IS NULL OR {t_t} IS NULL OR {f_t} >= {t_t})
           THEN 'intervalFrom and intervalTo must both be valid and ordered' END"""
    return f"""
{name}_p AS (
  SELECT value, json_valid(value) AS okv FROM {src}
),
{name}_j AS (
  SELECT value, okv AND json_type(CASE WHEN okv THEN value ELSE 'null' END) = 'OBJECT' AS ok,
         CASE WHEN okv AND json_type(CASE WHEN okv THEN value ELSE 'null' END) = 'OBJECT'
              THEN value ELSE '{{}}' END AS jv
  FROM {name}_p
),
{name} AS (
  SELECT value,
         COALESCE(TRY_CAST({js('$.version')} AS BIGINT), 1) AS version,
         COALESCE({js('$.jobType')}, 'extract-transform-load-metrics') AS jobType,
         {js('$.tenantId')} AS tenantId, {js('$.matchId')} AS matchId, {js('$.timelineId')} AS timelineId,
         {rng} AS timeRangeMinutes,
         CASE WHEN {explicit} THEN {f_t} END AS explicitFrom,
         CASE WHEN {explicit} THEN {t_t} END AS explicitTo,
         COALESCE(TRY_CAST({js('$.retryCount')} AS BIGINT), 0) AS retryCount,
         {js('$.origin')} AS origin, {js('$.correlationId')} AS correlationId,
         ({err}) IS NULL AS is_valid,
         {err} AS error_message
  FROM {name}_j
)"""


def align_sql(now_sql_ts: str = "TIMESTAMP '2024-01-15 10:30:00'") -> tuple[str, str]:
    now_ms = f"CAST(epoch_ms({now_sql_ts}) AS DOUBLE)"
    rms = "(timeRangeMinutes * 60000.0)"
    to_ms = f"(floor({now_ms} / {rms}) * {rms})"
    return (f"epoch_ms(CAST({to_ms} - {rms} AS BIGINT))", f"epoch_ms(CAST({to_ms} AS BIGINT))")


def encoded_backfill(src: str = "backfill") -> str:
    return (f"SELECT '{{\"version\":1,\"jobType\":\"extract-transform-load-metrics\",\"tenantId\":\"' || tenantId "
            f"|| '\",\"matchId\":\"' || matchId || '\",\"timelineId\":\"' || timelineId "
            f"|| '\",\"timeRangeMinutes\":5.0,\"intervalFrom\":\"' || intervalFrom || '\",\"intervalTo\":\"' "
            f"|| intervalTo || '\",\"retryCount\":0,\"origin\":\"backfill\",\"correlationId\":\"' || correlationId "
            f"|| '\"}}' AS value FROM {src}")


# ----------------------------------------------------------------- store oracle
def rollup_sql(src: str, cols: list[str], key: list[str], inc: list[str], double_inc: set[str],
               order: tuple[str, str] = ("intervalFrom", "timelineId")) -> str:
    part = ", ".join(key)
    sel = []
    for c in cols:
        if c in inc:
            if c in double_inc:
                sel.append(f"CAST(SUM(CAST({c} AS DECIMAL(38,2))) OVER (PARTITION BY {part}) AS DOUBLE) AS {c}")
            else:
                sel.append(f"CAST(SUM({c}) OVER (PARTITION BY {part}) AS BIGINT) AS {c}")
        else:
            sel.append(c)
    return (f"SELECT {', '.join(cols)} FROM (SELECT {', '.join(sel)}, row_number() OVER (PARTITION BY {part} "
            f"ORDER BY {order[0]} DESC, {order[1]} DESC) AS _rn FROM {src}) WHERE _rn = 1")

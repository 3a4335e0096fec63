"""Work-list operators: job messages, validation, interval resolution, expansion, and the
jobs x events range join (S7-S10, P7, P8, P12, T1, K1, K2, J1, J2, J4).

The reference sends one message per (tenant, match, timeline) job and runs the
metric queries per message.  Here a *DataFrame of jobs* is joined once with
the events, and every metric aggregates all jobs in one plan.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulseboard.operators.context import EVENT_PAYLOAD
from pulseboard.operators.predicates import to_utc, ts_lit
from pulseboard.schema import CONTEXT, JOB_SCHEMA
from pulseboard.session import ensure_checkpoint_dir

# Job message defaults and error texts.
JOB_VERSION = 1
JOB_TYPE = "extract-transform-load-metrics"
SCHEDULED_RANGE_MINUTES = 60
BACKFILL_DEFAULT_RANGE_MINUTES = 5
ERR_UNPARSEABLE = "Unparseable job message"
ERR_PAYLOAD = "Invalid timeline payload: missing tenantId, matchId, timelineId, or timeRangeMinutes"
ERR_FROM = "Missing or invalid job field: intervalFrom"
ERR_TO = "Missing or invalid job field: intervalTo"
ERR_ORDER = "intervalFrom and intervalTo must both be valid and ordered"


# ------------------------------------------------------------------ F6 / F7
def job_key(tenant="tenantId", match="matchId", timeline="timelineId") -> Column:
    """Message key ``tenant|match|timeline`` (keeps one timeline's jobs in order)."""
    return F.concat_ws("|", F.col(tenant), F.col(match), F.col(timeline))


def encode_jobs(jobs: DataFrame) -> DataFrame:
    """Jobs -> (key, value JSON) with ``version`` / ``jobType`` defaults; absent fields are omitted."""
    fields = [F.lit(JOB_VERSION).cast("long").alias("version"), F.lit(JOB_TYPE).alias("jobType")]
    for f in JOB_SCHEMA.fields:
        if f.name in ("version", "jobType"):
            continue
        if f.name in jobs.columns:
            fields.append(F.col(f.name).cast(f.dataType).alias(f.name))
    return jobs.select(job_key().alias("key"), F.to_json(F.struct(*fields)).alias("value"))


# ------------------------------------------------------------------ S7 / P7 / P8
def _is_string(v: Column, path: str) -> Column:
    return F.schema_of_variant(F.variant_get(v, path, "variant")) == F.lit("STRING")


def _is_number(v: Column, path: str) -> Column:
    t = F.schema_of_variant(F.variant_get(v, path, "variant"))
    return t.isin("BIGINT", "INT", "SMALLINT", "TINYINT", "DOUBLE", "FLOAT") | t.startswith("DECIMAL")


def _str(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "string")


def validate_jobs(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """Parse JSON job messages and decide validity (P7, P8) in one projection.

    Types are checked on the raw JSON (a number where a string is required is
    rejected; a plain ``from_json`` would silently turn it into a string).
    Output: the raw value, the parsed job fields, ``intervalFrom/To`` as
    timestamps when explicit, ``is_valid`` and ``error_message``.
    """
    v = F.try_parse_json(F.col(value_col))
    ok_json = v.isNotNull() & F.schema_of_variant(v).startswith("OBJECT")
    s_ok = [(_is_string(v, f"$.{k}") & (F.coalesce(F.length(_str(v, f"$.{k}")), F.lit(0)) > 0))
            for k in ("tenantId", "matchId", "timelineId")]
    rng = F.try_variant_get(v, "$.timeRangeMinutes", "double")
    rng_ok = _is_number(v, "$.timeRangeMinutes") & rng.isNotNull() & ~F.isnan(rng) \
        & (F.abs(rng) != F.lit(float("inf"))) & (rng > 0)
    payload_ok = s_ok[0] & s_ok[1] & s_ok[2] & rng_ok
    from_s, to_s = _str(v, "$.intervalFrom"), _str(v, "$.intervalTo")
    from_t, to_t = F.try_to_timestamp(from_s), F.try_to_timestamp(to_s)
    explicit = from_s.isNotNull() | to_s.isNotNull()
    error = (F.when(~ok_json, F.lit(ERR_UNPARSEABLE))
             .when(~payload_ok, F.lit(ERR_PAYLOAD))
             .when(from_s.isNotNull() & from_t.isNull(), F.lit(ERR_FROM))
             .when(to_s.isNotNull() & to_t.isNull(), F.lit(ERR_TO))
             .when(explicit & (from_t.isNull() | to_t.isNull() | (from_t >= to_t)), F.lit(ERR_ORDER)))
    return messages.select(
        F.col(value_col).alias("value"),
        F.coalesce(F.try_variant_get(v, "$.version", "long"), F.lit(JOB_VERSION).cast("long")).alias("version"),
        F.coalesce(_str(v, "$.jobType"), F.lit(JOB_TYPE)).alias("jobType"),
        _str(v, "$.tenantId").alias("tenantId"),
        _str(v, "$.matchId").alias("matchId"),
        _str(v, "$.timelineId").alias("timelineId"),
        rng.alias("timeRangeMinutes"),
        F.when(explicit, from_t).alias("explicitFrom"),
        F.when(explicit, to_t).alias("explicitTo"),
        F.coalesce(F.try_variant_get(v, "$.retryCount", "long"), F.lit(0).cast("long")).alias("retryCount"),
        _str(v, "$.origin").alias("origin"),
        _str(v, "$.correlationId").alias("correlationId"),
        error.isNull().alias("is_valid"),
        error.alias("error_message"),
    )


def dead_letters(validated: DataFrame, failed_at: datetime | str) -> DataFrame:
    """Rejected messages with the raw value kept (the reference loses it for bad JSON)."""
    return validated.where(~F.col("is_valid")).select(
        "value", F.col("error_message").alias("errorMessage"), ts_lit(failed_at).alias("failedAt"))


# ------------------------------------------------------------------ T1
def resolve_interval(jobs: DataFrame, now: datetime | str) -> DataFrame:
    """Explicit interval wins; else ``to = floor(now / range) * range``, ``from = to - range``
    on the UTC epoch grid (range in ms, fractional minutes allowed)."""
    now_ms = int(round(_utc_ms(now)))
    range_ms = F.col("timeRangeMinutes") * 60000.0
    to_ms = F.floor(F.lit(float(now_ms)) / range_ms) * range_ms
    aligned_to = F.timestamp_millis(to_ms.cast("long"))
    aligned_from = F.timestamp_millis((to_ms - range_ms).cast("long"))
    has_explicit = F.col("explicitFrom").isNotNull() & F.col("explicitTo").isNotNull()
    return jobs.withColumns({
        "intervalFrom": F.when(has_explicit, F.col("explicitFrom")).otherwise(aligned_from),
        "intervalTo": F.when(has_explicit, F.col("explicitTo")).otherwise(aligned_to),
    })


def _utc_ms(value) -> float:
    dt = to_utc(value)
    return dt.replace(tzinfo=timezone.utc).timestamp() * 1000


# ------------------------------------------------------------------ S9 / S10 / J1 / K1
def active_targets(targets: DataFrame, tenants: DataFrame) -> DataFrame:
    """Enabled targets whose tenant is ACTIVE (J1 semi join; the tenant list is a dimension)."""
    active = tenants.where(F.col("status") == "ACTIVE").select(F.col("name").alias("tenantId")).distinct()
    return targets.where(F.col("enabled")).join(active, "tenantId", "left_semi")


def skipped_targets(targets: DataFrame, tenants: DataFrame) -> DataFrame:
    """Enabled targets skipped because their tenant is not active (anti join)."""
    active = tenants.where(F.col("status") == "ACTIVE").select(F.col("name").alias("tenantId")).distinct()
    return targets.where(F.col("enabled")).join(active, "tenantId", "left_anti")


def expand_scheduled(targets: DataFrame, tenants: DataFrame, now: datetime | str) -> DataFrame:
    """K1: one job per timeline of every active target; 60-minute range, origin scheduled."""
    t = active_targets(targets, tenants)
    jobs = t.select("tenantId", "matchId", F.explode("timelineIds").alias("timelineId")).select(
        "tenantId", "matchId", "timelineId",
        F.lit(float(SCHEDULED_RANGE_MINUTES)).alias("timeRangeMinutes"),
        F.lit(0).cast("long").alias("retryCount"),
        F.lit("scheduled").alias("origin"),
        F.lit(to_utc(now).strftime("%Y-%m-%dT%H:%M:%S.000Z")).alias("scheduledAt"),
    )
    return jobs


def resolve_scheduled(jobs: DataFrame, now: datetime | str) -> DataFrame:
    """Scheduled jobs carry no explicit interval: align to the grid at ``now``."""
    return resolve_interval(jobs.withColumns({"explicitFrom": F.lit(None).cast("timestamp"),
                                              "explicitTo": F.lit(None).cast("timestamp")}), now)


# ------------------------------------------------------------------ K2 / P12
def expand_backfill(requests: DataFrame, caller_tenant_col: str | None = None,
                    correlation_id: str | Column | None = None) -> DataFrame:
    """K2: each backfill request (tenantId, matchId, timelineIds[], timeRangeMinutes?,
    intervalFrom?, intervalTo?) -> one job per timeline, origin backfill, shared correlation id.

    ``caller_tenant_col`` (P12) drops requests whose body tenant differs from the
    caller's.  The correlation id is a parameter or a column (not ``uuid()``, which
    is not deterministic under task retries).
    """
    r = requests
    if caller_tenant_col:
        r = r.where(F.col("tenantId") == F.col(caller_tenant_col))
    corr = (F.col(correlation_id) if isinstance(correlation_id, str) and correlation_id in r.columns
            else (correlation_id if isinstance(correlation_id, Column) else F.lit(correlation_id)))
    opt = {c: (F.col(c) if c in r.columns else F.lit(None).cast("string"))
           for c in ("intervalFrom", "intervalTo")}
    rng = F.col("timeRangeMinutes") if "timeRangeMinutes" in r.columns else F.lit(None)
    return r.select(
        "tenantId", "matchId", F.explode("timelineIds").alias("timelineId"),
        F.coalesce(rng.cast("double"), F.lit(float(BACKFILL_DEFAULT_RANGE_MINUTES))).alias("timeRangeMinutes"),
        opt["intervalFrom"].alias("intervalFrom"), opt["intervalTo"].alias("intervalTo"),
        F.lit(0).cast("long").alias("retryCount"), F.lit("backfill").alias("origin"),
        corr.cast("string").alias("correlationId"),
    )


def valid_jobs(validated: DataFrame, now: datetime | str) -> DataFrame:
    """Accepted messages with their processing interval (explicit, else aligned at ``now``)."""
    return resolve_interval(validated.where(F.col("is_valid")), now)


# ------------------------------------------------------------------ J2
MIN_LEVEL = 20  # smallest cell: 2^20 microseconds, about a second
LEVEL_STEP = 2  # cells grow by 2^2, so an event has at most some twenty cells, one per level in use


def job_cells(jobs: DataFrame, slices: int) -> DataFrame:
    """Each job once per aligned power-of-two time cell that it touches and per slice.

    The cell size (level) is the least allowed one that is no shorter than the job, so a job of any length
    touches one or two cells.  Jobs without a positive length hold no event and give no row."""
    first, last = F.unix_micros("intervalFrom"), F.unix_micros("intervalTo") - F.lit(1)
    bits = F.ceil(F.log2(last - first + F.lit(1)) / F.lit(LEVEL_STEP)) * F.lit(LEVEL_STEP)
    leveled = jobs.where(F.col("intervalFrom") < F.col("intervalTo")).withColumn(
        "_level", F.greatest(F.lit(MIN_LEVEL), bits).cast("int"))
    cells = leveled.withColumn("_cell", F.explode(F.sequence(_cell(first), _cell(last))))
    return cells.withColumn("_slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))


def _cell(micros: Column) -> Column:
    return F.call_function("shiftright", micros, F.col("_level"))


EVENT_IDS = {"tenant_id": "tenantId", "timeline_id": "timelineId", "media_content_id": "matchId"}


def jobs_join_events(jobs: DataFrame, events: DataFrame, *, environment: str | None, slices: int = 16,
                     counts: dict[str, Column] | None = None) -> DataFrame:
    """Attach every event to each job it belongs to (tenant, match, timeline equal and
    ``intervalFrom <= ts < intervalTo``); overlapping jobs each get the event, repeated jobs count once.

    An interval join by aligned cells: a job lies in one or two cells of its own level, an event in one cell of
    each level that the job list uses, so an event meets a job in at most one cell and only near its interval.
    The events of a cell are dealt into ``slices`` by hash and the jobs repeated for each, so a live match
    whose events share one cell is joined by that many tasks.  Nothing is counted beforehand; whether the job list is
    broadcast is left to the optimizer's size estimate.

    With ``counts`` (name -> condition on an event) the joined rows are not made: each job that has an event comes
    once, with the number of its events that meet each condition (``count_in_jobs``).  Where jobs overlap, the rows
    grow with the product of jobs and events and the counts do not.

    ``environment`` is the deployment's own (null: events of all).  Events without time or ids belong to no job.
    """
    cond = F.col("ts").isNotNull()
    if environment is not None:
        cond = cond & (F.col("environment") == F.lit(environment))
    ev = events.where(cond & F.col("tenant_id").isNotNull() & F.col("timeline_id").isNotNull()
                      & F.col("media_content_id").isNotNull())
    if counts is not None:
        return count_in_jobs(jobs.select(*CONTEXT).distinct(), ev, counts)
    j = job_cells(jobs.select(*CONTEXT).distinct(), slices)
    levels = j.agg(F.collect_set("_level")).scalar()  # a handful of numbers, whatever the length of the list
    ev = (ev.withColumn("_level", F.explode(levels))
          .withColumns({"_cell": _cell(F.unix_micros("ts")),
                        "_slice": F.pmod(F.xxhash64("ts", "event_id"), F.lit(slices)).cast("int")}))
    on = [ev[e] == j[k] for e, k in EVENT_IDS.items()]
    on += [ev[c] == j[c] for c in ("_level", "_cell", "_slice")]
    on += [ev["ts"] >= j["intervalFrom"], ev["ts"] < j["intervalTo"]]
    return ev.join(j, on, "inner").select(*CONTEXT, *[ev[c] for c in EVENT_PAYLOAD if c in events.columns])


def count_in_jobs(jobs: DataFrame, events: DataFrame, counts: dict[str, Column]) -> DataFrame:
    """CONTEXT and the ``counts`` of each job (distinct) with at least one of ``events`` (with time and ids).

    A job's count is the number of events before its end less the number before its start, both in the order of
    (ids, time).  Events and job ends are combined into one row per ids and time and dealt by range, so a hot
    timeline or hour is many partitions; running sums inside a partition start from the totals of those before it."""
    ids, names = list(EVENT_IDS.values()), [f"_n{i}" for i in range(len(counts) + 1)]
    j = jobs.where(F.col("intervalFrom") < F.col("intervalTo")).dropna(subset=ids)
    met = [F.lit(True), *counts.values()]  # the first counts all
    at = events.select(*[F.col(e).alias(k) for e, k in EVENT_IDS.items()], F.col("ts").alias("_at"),
                       *[F.when(c, 1).otherwise(0).alias(n) for n, c in zip(names, met, strict=True)], F.lit(False).alias("_end"))
    ends = j.select(*ids, F.explode(F.array("intervalFrom", "intervalTo")).alias("_at"), *[F.lit(0).alias(n) for n in names],
                    F.lit(True).alias("_end"))
    points = at.unionByName(ends).groupBy(*ids, "_at").agg(*[F.sum(n).alias(n) for n in names], F.max("_end").alias("_end"))
    points = points.repartitionByRange(*ids, "_at").withColumn("_part", F.spark_partition_id())
    spark = points.sparkSession  # written once: the range borders are drawn anew each time they are computed
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/job-points-{uuid.uuid4().hex}"
    points.write.parquet(path)
    points = spark.read.schema(points.schema).parquet(path)

    def before(w) -> list[Column]:
        return [F.coalesce(F.sum(n).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(n) for n in names]

    totals = points.groupBy("_part").agg(*[F.sum(n).alias(n) for n in names])  # a row per partition
    offsets = totals.select(F.col("_part").alias("_p"), *[c.alias(f"_o{n}") for n, c in zip(names, before(Window.orderBy("_part")), strict=True)])
    running = points.select(*ids, "_at", "_end", "_part", *before(Window.partitionBy("_part").orderBy(*ids, "_at"))).where("_end")
    running = running.join(F.broadcast(offsets), F.col("_part") == F.col("_p")).select(
        *ids, "_at", *[(F.col(n) + F.col(f"_o{n}")).alias(n) for n in names])
    first = running.select(*ids, F.col("_at").alias("intervalFrom"), *[F.col(n).alias(f"_f{n}") for n in names])
    last = running.select(*ids, F.col("_at").alias("intervalTo"), *names)
    found = j.join(first, [*ids, "intervalFrom"]).join(last, [*ids, "intervalTo"]).where(F.col(names[0]) > F.col(f"_f{names[0]}"))
    return found.select(*CONTEXT, *[(F.col(n) - F.col(f"_f{n}")).alias(c) for c, n in zip(counts, names[1:], strict=True)])


# ------------------------------------------------------------------ J4
def zero_fill_latency(jobs: DataFrame, latency_flat: DataFrame) -> DataFrame:
    """Exactly one latency row per job: jobs without events get all-zero values."""
    j = jobs.select(*CONTEXT).distinct()
    metric_cols = [c for c in latency_flat.columns if c not in CONTEXT]
    out = j.join(latency_flat, CONTEXT, "left")
    return out.select("timelineId", "matchId", "tenantId", "intervalFrom", "intervalTo",
                      *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in metric_cols])

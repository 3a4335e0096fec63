"""Job context: attach G = (tenantId, matchId, timelineId, intervalFrom, intervalTo).

The reference runs one query set per (tenant, match, timeline, interval) job.
Here every event is tagged with the job it belongs to and all jobs are
aggregated in one plan.  Two ways to tag:

* :func:`grid_context` - the scheduled hourly run for every timeline present in
  the data: the interval is the epoch-aligned tumbling window that contains the
  event (a pure projection, no join, no shuffle).
* ``plans.jobs.jobs_join_events`` - explicit jobs (backfills, arbitrary ranges).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseboard.functions.time import bucket_start, interval_micros
from pulseboard.schema import CONTEXT, EVENT_LABELS, EVENT_NUMERICS

EVENT_PAYLOAD = ["event_id", "ts", *[c for c in EVENT_LABELS if c not in ("tenant_id", "timeline_id", "media_content_id")],
                 *EVENT_NUMERICS]


def _non_empty(c: str):
    return F.col(c).isNotNull() & (F.col(c) != "")


def grid_context(events: DataFrame, minutes: float = 60, *, environment: str | None) -> DataFrame:
    """Tag events with their processing interval on a fixed UTC grid (T5).

    A job needs non-empty tenant, match and timeline ids (job validation), so
    events without them belong to no job.  ``environment`` is the deployment's
    own, which ETL jobs filter on (null: events of all).
    """
    step = interval_micros(minutes)
    cond = _non_empty("tenant_id") & _non_empty("media_content_id") & _non_empty("timeline_id") \
        & F.col("ts").isNotNull()
    if environment is not None:
        cond = cond & (F.col("environment") == F.lit(environment))
    start = bucket_start("ts", step)
    return events.where(cond).select(
        F.col("tenant_id").alias("tenantId"),
        F.col("media_content_id").alias("matchId"),
        F.col("timeline_id").alias("timelineId"),
        start.alias("intervalFrom"),
        F.timestamp_micros(F.unix_micros(start) + F.lit(step)).alias("intervalTo"),
        *[c for c in EVENT_PAYLOAD if c in events.columns],
    )


def literal_context(events: DataFrame, *, tenant_col: str = "tenant_id", match_id: str = "",
                    timeline_id: str = "", interval_from=None, interval_to=None) -> DataFrame:
    """Context of a realtime request: fixed ids and interval, tenant from the event."""
    from pulseboard.operators.predicates import ts_lit
    return events.select(
        F.col(tenant_col).alias("tenantId"),
        F.lit(match_id).alias("matchId"),
        F.lit(timeline_id).alias("timelineId"),
        ts_lit(interval_from).alias("intervalFrom"),
        ts_lit(interval_to).alias("intervalTo"),
        *[c for c in EVENT_PAYLOAD if c in events.columns],
    )


__all__ = ["CONTEXT", "grid_context", "literal_context", "EVENT_PAYLOAD"]


def match_level(base: DataFrame) -> DataFrame:
    """The same events as one job per match and interval (timelineId empty): metrics of it are recomputed over
    all events of a match, not combined from its timelines' rows."""
    return base.withColumn("timelineId", F.lit(""))

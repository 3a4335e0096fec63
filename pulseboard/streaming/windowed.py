"""Structured Streaming versions of the metrics (ST1, ST2).

The reference polls by cron and loses events that arrive after their interval
ran (until a manual backfill).  Here the metrics are event-time tumbling
windows with a watermark: late events within the watermark update their
window; later ones are dropped by the stream and left to a backfill (K3).

The event-time window is the grouping key, so the watermark evicts the state
of finished windows.  Update mode emits the current value of every changed
bucket; the sink replaces rows (see streaming.sinks).  Top-N truncation needs
all buckets of a job: the contribution table keeps every bucket and the sink
truncates per job before deriving the match table (``platform_top_n``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseboard.functions.numeric import key_or_unknown
from pulseboard.functions.time import parse_interval
from pulseboard.operators import metrics as M
from pulseboard.operators.topk import top_n_per_group
from pulseboard.schema import CONTEXT

def _ids() -> list:
    return [F.col("tenant_id").alias("tenantId"), F.col("media_content_id").alias("matchId"),
            F.col("timeline_id").alias("timelineId")]


def _job_events(events: DataFrame, environment: str | None, watermark: str | None) -> DataFrame:
    cond = (F.col("tenant_id").isNotNull() & (F.col("tenant_id") != "") & F.col("media_content_id").isNotNull()
            & (F.col("media_content_id") != "") & F.col("timeline_id").isNotNull() & (F.col("timeline_id") != "")
            & F.col("ts").isNotNull())
    if environment is not None:
        cond = cond & (F.col("environment") == F.lit(environment))
    return events.where(cond) if watermark is None else events.where(cond).withWatermark("ts", watermark)


def stream_platform_metrics(events: DataFrame, minutes: int = 60, watermark: str | None = "10 minutes", *,
                            environment: str | None, keep_doc_count: bool = False) -> DataFrame:
    """A3 per (tenant, match, timeline, event-time window, platform) on a stream.

    ``keep_doc_count`` carries the bucket's row count, which the sink needs to
    apply the top-N limit (:func:`platform_top_n`).  ``watermark`` is null for events that bring their own
    (``streaming.late.drop_repeats``).
    """
    ev = _job_events(events, environment, watermark)
    agg = ev.groupBy(F.window("ts", f"{minutes} minutes").alias("w"), *_ids(),
                     key_or_unknown("platform").alias("platform")).agg(*M.platform_aggregations())
    raw = agg.select(F.col("w.start").alias("intervalFrom"), F.col("w.end").alias("intervalTo"),
                     "tenantId", "matchId", "timelineId", "platform", "sent_raw", "received_raw",
                     "rendered_raw", "failed_raw", "avg_render_raw", "doc_count")
    out = M.derive_platform(raw)
    if keep_doc_count:
        out = raw.select("timelineId", "matchId", "tenantId", "platform", *M.platform_derived_columns(),
                         "intervalFrom", "intervalTo", "doc_count")
    return out


def platform_top_n(n: int):
    """Sink-side top-N of the platform buckets of each job (count desc, key asc)."""
    def apply(contrib: DataFrame) -> DataFrame:
        return top_n_per_group(contrib, CONTEXT, "doc_count", "platform", n).drop("doc_count")
    return apply


def stream_timeseries_buckets(events: DataFrame, job_minutes: int = 60, interval: str = "5m",
                              watermark: str = "10 minutes", *, environment: str | None) -> DataFrame:
    """A11 raw measures per non-empty bucket; the bucket window carries the event time.

    The job interval is a plain function of the event time (the bucket must
    divide the job interval).  Gap fill and the long format are applied on read
    (``operators.metrics.fill_gaps``) since empty buckets are not events.
    """
    step = parse_interval(interval)
    job_step = job_minutes * 60_000_000
    if job_step % step:
        raise ValueError("the bucket interval must divide the job interval")
    ev = _job_events(events, environment, watermark)
    us = F.unix_micros("ts")
    job_start = us - F.pmod(us, F.lit(job_step))
    agg = ev.groupBy(F.window("ts", f"{step // 1_000_000} seconds").alias("w"), *_ids(),
                     F.timestamp_micros(job_start).alias("intervalFrom"),
                     F.timestamp_micros(job_start + F.lit(job_step)).alias("intervalTo")
                     ).agg(*M.timeseries_aggregations())
    return agg.select("tenantId", "matchId", "timelineId", "intervalFrom", "intervalTo",
                      F.unix_micros(F.col("w.start")).alias("_b"), "_sent", "_received", "_rendered",
                      "_failed", "_avg")

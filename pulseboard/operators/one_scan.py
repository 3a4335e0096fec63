"""All seven metric tables from one scan of the events.

Every event is unfolded into one row per bucket it counts in: its platform, its three device keys, its transport mode with its
render time, its SDK version, its failure reason and step, its time bucket, and one value (or none) of each latency series.  One
aggregation, combined before its shuffle, turns these into the long pre-aggregate

    (job, kind, key, step, v, b) -> rows, received, rendered, failed, room, ms, ms_n

which holds every additive measure and the value counts that exact percentiles are selected from.  It is written once; each table is a
filter on ``kind`` and the derivation that the single metric uses as well, so both give the same values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseboard.functions.numeric import key_or_unknown, measured, stage_is
from pulseboard.functions.time import parse_interval
from pulseboard.operators import metrics as M
from pulseboard.operators.percentiles import finite
from pulseboard.schema import (
    CONTEXT, DEVICE_DIMENSIONS, ETL_TIMESERIES_INTERVAL, STAGE_FAILED, STAGE_RECEIVED, STAGE_RENDERED, STAGE_SENT,
)

KEY = [*CONTEXT, "kind", "key", "step", "v", "b"]


def _row(kind: str, key: Column | None = None, step: Column | None = None, v: Column | None = None, b: Column | None = None,
         room: Column | None = None, ms: Column | None = None) -> Column:
    cells = {"key": (key, "string"), "step": (step, "string"), "v": (v, "double"), "b": (b, "long"), "room": (room, "decimal(38,6)"), "ms": (ms, "decimal(38,6)")}
    return F.struct(F.lit(kind).alias("kind"), *[(F.lit(None) if c is None else c).cast(t).alias(n) for n, (c, t) in cells.items()])


def pre_aggregate(base: DataFrame, interval: str = ETL_TIMESERIES_INTERVAL) -> DataFrame:
    """The long pre-aggregate of job-tagged events."""
    step, us = parse_interval(interval), F.unix_micros("ts")
    room, ms, rendered = F.col("room_size"), F.col("render_duration_ms"), stage_is(STAGE_RENDERED)
    rendered_ms = measured(F.when(rendered, ms))
    rows = [_row("platform", key_or_unknown("platform"), room=measured(F.when(stage_is(STAGE_SENT), room)), ms=rendered_ms),
            *[_row(f"device:{d}", key_or_unknown(c), ms=rendered_ms) for d, c in DEVICE_DIMENSIONS.items()],
            _row("transport", key_or_unknown("transport_mode"), v=finite(F.when(rendered, ms))),
            _row("sdk", key_or_unknown("sdk_version"), ms=rendered_ms),
            _row("timeseries", b=us - F.pmod(us, F.lit(step)), room=measured(room), ms=measured(ms)),
            *[_row("latency", F.lit(name), v=finite(F.col(c))) for name, c in M.LATENCY_SERIES.items()],
            F.when(F.col("failure_reason").isNotNull(), _row("failure", M.failure_key("failure_reason"), M.failure_key("failure_step")))]
    one = lambda stage: F.when(stage_is(stage), 1).otherwise(0)
    long = base.select(*CONTEXT, one(STAGE_RECEIVED).alias("received"), one(STAGE_RENDERED).alias("rendered"), one(STAGE_FAILED).alias("failed"),
                       F.inline(F.array_compact(F.array(*rows))))
    return long.groupBy(*KEY).agg(F.count(F.lit(1)).alias("rows"), *[F.sum(c).alias(c) for c in ("received", "rendered", "failed", "room", "ms")],
                                  F.count("ms").alias("ms_n"))


def _avg() -> Column:
    return F.when(F.col("ms_n") > 0, F.col("ms").cast("double") / F.col("ms_n"))


def _platform(pre: DataFrame) -> DataFrame:
    return M.derive_platform(pre.where("kind = 'platform'").select(
        *CONTEXT, F.col("key").alias("platform"), F.col("room").cast("double").alias("sent_raw"), F.col("received").alias("received_raw"),
        F.col("rendered").alias("rendered_raw"), F.col("failed").alias("failed_raw"), _avg().alias("avg_render_raw"), F.col("rows").alias("doc_count")))


def _device(pre: DataFrame) -> DataFrame:
    return M.derive_device(pre.where(F.startswith("kind", F.lit("device:"))).select(
        *CONTEXT, F.substring_index("kind", ":", -1).alias("dimension"), F.col("key").alias("bucketKey"), "received", "rendered", "failed",
        _avg().alias("avg_render_raw"), F.col("rows").alias("doc_count")))


def _transport(pre: DataFrame) -> DataFrame:
    return M.transport_from_counts(pre.where("kind = 'transport'").select(
        *CONTEXT, F.col("key").alias("transportMode"), F.col("v").alias("_v"), F.col("rows").alias("_c"), F.col("received").alias("_received"), F.col("rendered").alias("_rendered")))


def _sdk(pre: DataFrame) -> DataFrame:
    return M.derive_sdk(pre.where("kind = 'sdk'").select(
        *CONTEXT, F.col("key").alias("sdkVersion"), F.col("rows").alias("count"), F.col("received").alias("_received"), F.col("rendered").alias("_rendered"), _avg().alias("_avg")))


def _failure(pre: DataFrame) -> DataFrame:
    return M.failure_from_steps(pre.where("kind = 'failure'").select(*CONTEXT, F.col("key").alias("failureReason"), F.col("step").alias("failureStep"), F.col("rows").alias("count")))


def latency_flat(pre: DataFrame) -> DataFrame:
    counts = pre.where("kind = 'latency'").select(*CONTEXT, F.col("key").alias("_series"), F.col("v").alias("_v"), F.col("rows").alias("_c"))
    return M.derive_latency_flat(M.latency_from_counts(counts, CONTEXT))


def _timeseries(pre: DataFrame) -> DataFrame:
    return M.timeseries_from_buckets(pre.where("kind = 'timeseries'").select(
        *CONTEXT, F.col("b").alias("_b"), F.col("room").cast("double").alias("_sent"), F.col("received").alias("_received"), F.col("rendered").alias("_rendered"),
        F.col("failed").alias("_failed"), _avg().alias("_avg")))


#: Metric -> its table from the pre-aggregate (latency: nested, as stored).
TABLES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "platform": _platform, "device": _device, "transport": _transport, "sdk": _sdk, "failure": _failure,
    "latency": lambda pre: M.latency_nested(latency_flat(pre)), "timeseries": _timeseries,
}

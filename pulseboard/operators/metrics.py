"""The seven metric tables (A3-A12) as DataFrame aggregations over job-tagged events.

Input: flat events carrying the job context ``CONTEXT`` (see operators.context).
Output: one row per job and bucket key, exactly the columns of the stored table.
Every metric is a single ``groupBy`` with partial (map-side) aggregation; where
the reference issues one query per dimension or metric, one pass is used here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulseboard.functions.numeric import exact_avg, exact_sum, key_or_unknown, r2, r2_sql, rate, stage_is
from pulseboard.functions.time import parse_interval
from pulseboard.operators.percentiles import distribution, finite, value_counts
from pulseboard.operators.topk import top_n_per_group
from pulseboard.schema import (
    CONTEXT, DEVICE_DIMENSIONS, ETL_TIMESERIES_INTERVAL, LATENCY_PERCENTS, STAGE_FAILED,
    STAGE_RECEIVED, STAGE_RENDERED, STAGE_SENT, TIMESERIES_METRICS,
)

_IDS = ["timelineId", "matchId", "tenantId"]
_INTERVAL = ["intervalFrom", "intervalTo"]


def _count_stage(stage: str):
    return F.count(F.when(stage_is(stage), F.lit(1)))


# ---------------------------------------------------------------- A3 platform
def platform_aggregations() -> list:
    """Raw per-bucket aggregates of the platform table (shared by batch and streaming)."""
    return [
        exact_sum(F.when(stage_is(STAGE_SENT), F.col("room_size"))).alias("sent_raw"),
        _count_stage(STAGE_RECEIVED).alias("received_raw"),
        _count_stage(STAGE_RENDERED).alias("rendered_raw"),
        _count_stage(STAGE_FAILED).alias("failed_raw"),
        exact_avg(F.when(stage_is(STAGE_RENDERED), F.col("render_duration_ms"))).alias("avg_render_raw"),
        F.count(F.lit(1)).alias("doc_count"),
    ]


def platform_raw(base: DataFrame, top_n: int | None = None) -> DataFrame:
    """Bucket-level aggregates before derivation (what the store returns)."""
    agg = base.groupBy(*CONTEXT, key_or_unknown("platform").alias("platform")).agg(*platform_aggregations())
    return top_n_per_group(agg, CONTEXT, "doc_count", "platform", top_n)


def platform_derived_columns() -> list:
    """Derived platform columns as expressions over the raw bucket aggregates."""
    sent = r2_sql("sent_raw")
    return [
        F.expr(sent).alias("sent"),
        F.col("received_raw").alias("received"), F.col("rendered_raw").alias("rendered"),
        F.col("failed_raw").alias("failed"),
        rate("received_raw", sent).alias("receiveRate"),
        rate("rendered_raw", "received_raw").alias("renderRate"),
        rate("failed_raw", "received_raw").alias("failureRate"),
        rate("rendered_raw", sent).alias("netSuccessRate"),
        r2("avg_render_raw").alias("avgRenderMs"),
    ]


def derive_platform(raw: DataFrame) -> DataFrame:
    return raw.select(*_IDS, "platform", *platform_derived_columns(), *_INTERVAL)


def platform_metrics(base: DataFrame, top_n: int | None = None) -> DataFrame:
    """A3: funnel counts and rates per platform (top 100 platforms per job)."""
    return derive_platform(platform_raw(base, top_n))


# ---------------------------------------------------------------- A4 device
def device_dimension_column(dimension: str) -> str:
    """P10: dimension name -> event label; unknown names fall back to browser."""
    return DEVICE_DIMENSIONS.get(dimension, DEVICE_DIMENSIONS["browser"])


def device_breakdown(base: DataFrame, dimensions: list[str] | None = None,
                     top_n: int | None = None) -> DataFrame:
    """A4: received/rendered/failed per (dimension, bucketKey), top 50 keys per dimension.

    All dimensions come from ONE scan: each event is unpivoted into one
    (dimension, key) pair per dimension with ``inline``, then aggregated once;
    the unpivoted rows never leave the map side (partial aggregation).
    """
    dims = list(DEVICE_DIMENSIONS) if dimensions is None else list(dimensions)
    pairs = F.array(*[
        F.struct(F.lit(d).alias("dimension"), key_or_unknown(device_dimension_column(d)).alias("bucketKey"))
        for d in dims
    ])
    unpivoted = base.select(*CONTEXT, "stage", "render_duration_ms", F.inline(pairs))
    agg = unpivoted.groupBy(*CONTEXT, "dimension", "bucketKey").agg(
        _count_stage(STAGE_RECEIVED).alias("received"),
        _count_stage(STAGE_RENDERED).alias("rendered"),
        _count_stage(STAGE_FAILED).alias("failed"),
        exact_avg(F.when(stage_is(STAGE_RENDERED), F.col("render_duration_ms"))).alias("avg_render_raw"),
        F.count(F.lit(1)).alias("doc_count"),
    )
    return derive_device(agg, top_n)


def derive_device(agg: DataFrame, top_n: int | None = None) -> DataFrame:
    top = top_n_per_group(agg, [*CONTEXT, "dimension"], "doc_count", "bucketKey", top_n)
    return top.select(
        *_IDS, "dimension", "bucketKey", "received", "rendered", "failed",
        rate("rendered", "received").alias("renderRate"),
        r2("avg_render_raw").alias("avgRenderMs"),
        *_INTERVAL,
    )


# ---------------------------------------------------------------- A5 transport
def transport_comparison(base: DataFrame, top_n: int | None = None,
                         approx_accuracy: int | None = None) -> DataFrame:
    """A5: count of all rows, render rate, avg and exact p95 render time per transport mode.

    The p95 is selected from counts of (job, mode, render time) (operators.percentiles): the same plan
    for every size of a group.  ``approx_accuracy`` takes the mergeable ``percentile_approx`` sketch instead.
    """
    rendered_ms = F.when(stage_is(STAGE_RENDERED), F.col("render_duration_ms"))
    keyed = base.withColumn("transportMode", key_or_unknown("transport_mode"))
    if approx_accuracy is not None:
        agg = keyed.groupBy(*CONTEXT, "transportMode").agg(
            F.count(F.lit(1)).alias("count"), _count_stage(STAGE_RECEIVED).alias("_received"), _count_stage(STAGE_RENDERED).alias("_rendered"),
            exact_avg(rendered_ms).alias("_avg"), F.percentile_approx(rendered_ms, F.lit(0.95), F.lit(approx_accuracy)).alias("_p95"))
        return derive_transport(agg, top_n)
    counts = value_counts(keyed, [*CONTEXT, "transportMode"], rendered_ms, {
        "_received": F.when(stage_is(STAGE_RECEIVED), 1).otherwise(0), "_rendered": F.when(stage_is(STAGE_RENDERED), 1).otherwise(0)})
    return transport_from_counts(counts, top_n)


def transport_from_counts(counts: DataFrame, top_n: int | None = None) -> DataFrame:
    """The table from value counts (CONTEXT, transportMode, _v, _c, _received, _rendered)."""
    found = distribution(counts, [*CONTEXT, "transportMode"], [0.95], ["_received", "_rendered"])
    return derive_transport(found.select(*CONTEXT, "transportMode", F.col("rows").alias("count"), "_received", "_rendered",
                                         F.col("avg").alias("_avg"), F.col("p0").alias("_p95")), top_n)


def derive_transport(agg: DataFrame, top_n: int | None = None) -> DataFrame:
    top = top_n_per_group(agg, CONTEXT, "count", "transportMode", top_n)
    return top.select(
        *_IDS, "transportMode", "count",
        rate("_rendered", "_received").alias("renderRate"),
        r2("_avg").alias("avgRenderMs"),
        r2("_p95").alias("p95RenderMs"),
        *_INTERVAL,
    )


# ---------------------------------------------------------------- A6 sdk
def sdk_versions(base: DataFrame, top_n: int | None = None) -> DataFrame:
    """Count of all rows, render rate and avg render time per SDK version."""
    agg = base.groupBy(*CONTEXT, key_or_unknown("sdk_version").alias("sdkVersion")).agg(
        F.count(F.lit(1)).alias("count"),
        _count_stage(STAGE_RECEIVED).alias("_received"),
        _count_stage(STAGE_RENDERED).alias("_rendered"),
        exact_avg(F.when(stage_is(STAGE_RENDERED), F.col("render_duration_ms"))).alias("_avg"),
    )
    return derive_sdk(agg, top_n)


def derive_sdk(agg: DataFrame, top_n: int | None = None) -> DataFrame:
    top = top_n_per_group(agg, CONTEXT, "count", "sdkVersion", top_n)
    return top.select(
        *_IDS, "sdkVersion", "count",
        rate("_rendered", "_received").alias("renderRate"),
        r2("_avg").alias("avgRenderMs"),
        *_INTERVAL,
    )


# ---------------------------------------------------------------- A7 failure
def failure_analysis(base: DataFrame, top_reasons: int | None = None,
                     top_steps: int | None = None) -> DataFrame:
    """Nested terms reason -> step, any stage, with the share of the emitted total.

    Rows without a reason belong to no bucket.  A row with a reason but no step
    counts towards its reason's rank but yields no output row.  Reasons are
    ranked by their total (top ``top_reasons``), steps within a reason by count
    (top ``top_steps``); ``percentOfFailed`` divides by the sum of emitted rows.
    """
    steps = (base.where(F.col("failure_reason").isNotNull())
             .groupBy(*CONTEXT, failure_key("failure_reason").alias("failureReason"), failure_key("failure_step").alias("failureStep"))
             .agg(F.count(F.lit(1)).alias("count")))
    return failure_from_steps(steps, top_reasons, top_steps)


def failure_key(c: str):
    """'' is a real term, printed as 'unknown'; null is none."""
    return F.when(F.col(c) == "", F.lit("unknown")).otherwise(F.col(c))


def failure_from_steps(steps: DataFrame, top_reasons: int | None = None, top_steps: int | None = None) -> DataFrame:
    """The table from counts (CONTEXT, failureReason, failureStep, count).

    A job's free-text reasons are never gathered: reason totals are an aggregation by (job, reason), a top-N keeps N rows
    per task before its rows meet, and the job's total is an aggregate joined back (a hot job's side is split by AQE).
    """
    if top_reasons is not None:
        totals = steps.groupBy(*CONTEXT, "failureReason").agg(F.sum("count").alias("_reason_n"))
        best = top_n_per_group(totals, CONTEXT, "_reason_n", "failureReason", top_reasons)
        steps = steps.join(best.select(*CONTEXT, "failureReason"), [*CONTEXT, "failureReason"], "left_semi")
    steps = top_n_per_group(steps.where(F.col("failureStep").isNotNull()), [*CONTEXT, "failureReason"], "count", "failureStep", top_steps)
    total = steps.groupBy(*CONTEXT).agg(F.sum("count").alias("_total"))
    return steps.join(total, CONTEXT).select(
        *_IDS, "failureReason", "failureStep", "count",
        F.when(F.col("_total") > 0, r2(F.col("count") / F.col("_total") * 100)).otherwise(F.lit(0.0)).alias("percentOfFailed"),
        *_INTERVAL,
    )


# ---------------------------------------------------------------- A8-A10 latency
LATENCY_SERIES = {"receive": "receive_latency_ms", "render": "render_duration_ms", "ack": "ack_latency_ms"}


def latency_aggregates(base: DataFrame, group_cols: list[str] | None = None,
                       approx_accuracy: int | None = None, with_stats: bool = False) -> DataFrame:
    """Raw percentile and stats aggregates per group (no stage filter); without group columns always one row.

    All three series come from one scan: each event is one value (or none) of each series, and percentiles, average and extremes are
    taken from counts of (group, series, value) - one plan for every size of a group.  ``approx_accuracy`` gives the bounded-memory sketch.
    """
    group_cols = list(CONTEXT if group_cols is None else group_cols)
    if approx_accuracy is not None:
        ps, aggs = F.array(*[F.lit(p / 100.0) for p in LATENCY_PERCENTS]), []
        for name, col in LATENCY_SERIES.items():
            x = finite(F.col(col))
            pct = F.percentile_approx(x, ps, F.lit(approx_accuracy))
            aggs += [F.get(pct, i).alias(f"{name}_p{p}_raw") for i, p in enumerate(LATENCY_PERCENTS)]
            aggs += [exact_avg(x).alias(f"{name}_avg_raw"), F.max(x).alias(f"{name}_max_raw")]
            if with_stats:
                aggs += [F.min(x).alias(f"{name}_min_raw"), F.count(x).alias(f"{name}_count"), exact_sum(x).alias(f"{name}_sum_raw")]
        return (base.groupBy(*group_cols) if group_cols else base.groupBy()).agg(*aggs)
    series = F.array(*[F.struct(F.lit(n).alias("_series"), F.col(c).alias("_x")) for n, c in LATENCY_SERIES.items()])
    long = base.select(*group_cols, F.inline(series))
    return latency_from_counts(value_counts(long, [*group_cols, "_series"], F.col("_x")), group_cols, with_stats)


def latency_from_counts(counts: DataFrame, group_cols: list[str], with_stats: bool = False) -> DataFrame:
    """The raw aggregates from value counts (group columns, _series, _v, _c); every group has a row per series, of nulls if it has no value."""
    found = distribution(counts, [*group_cols, "_series"], [p / 100.0 for p in LATENCY_PERCENTS])
    of = lambda name, c: F.max(F.when(F.col("_series") == name, F.col(c)))
    aggs = []
    for name in LATENCY_SERIES:
        aggs += [of(name, "avg").alias(f"{name}_avg_raw"), of(name, "most").alias(f"{name}_max_raw")]
        if with_stats:
            aggs += [of(name, "least").alias(f"{name}_min_raw"), F.coalesce(of(name, "n"), F.lit(0)).alias(f"{name}_count"),
                     of(name, "total").cast("double").alias(f"{name}_sum_raw")]
        aggs += [of(name, f"p{i}").alias(f"{name}_p{p}_raw") for i, p in enumerate(LATENCY_PERCENTS)]
    return (found.groupBy(*group_cols) if group_cols else found.groupBy()).agg(*aggs)


def derive_latency_flat(raw: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Flat latency row: receive_p50 ... ack_max, renderDuration_* copied from render."""
    keep = [*_IDS, *_INTERVAL] if keep is None else keep
    return raw.select(*keep, *latency_derived_columns())


def latency_derived_columns() -> list:
    cols = []
    for name in LATENCY_SERIES:
        for p in LATENCY_PERCENTS:
            cols.append(r2(f"{name}_p{p}_raw").alias(f"{name}_p{p}"))
        cols.append(r2(f"{name}_avg_raw").alias(f"{name}_avg"))
        cols.append(r2(f"{name}_max_raw").alias(f"{name}_max"))
    for p in (50, 95, 99):
        cols.append(r2(f"render_p{p}_raw").alias(f"renderDuration_p{p}"))
    cols.append(r2("render_avg_raw").alias("renderDuration_avg"))
    return cols


def latency_percentiles(base: DataFrame, approx_accuracy: int | None = None) -> DataFrame:
    """One flat latency row per job (jobs with events; see latency_zero_fill)."""
    return derive_latency_flat(latency_aggregates(base, approx_accuracy=approx_accuracy))


def latency_nested(flat: DataFrame) -> DataFrame:
    """Store shape: receive/render/ack {p50,p75,p95,p99,avg,max}, renderDuration {p50,p95,p99,avg}."""
    def block(name, fields):
        return F.struct(*[F.col(f"{name}_{f}").alias(f) for f in fields]).alias(name)
    full = ["p50", "p75", "p95", "p99", "avg", "max"]
    return flat.select(*_IDS, block("receive", full), block("render", full), block("ack", full),
                       block("renderDuration", ["p50", "p95", "p99", "avg"]), *_INTERVAL)


# ---------------------------------------------------------------- A11/A12 timeseries
def timeseries_wide(base: DataFrame, interval: str = ETL_TIMESERIES_INTERVAL) -> DataFrame:
    """Per job and fixed-interval bucket: the five raw measures, gaps filled with zeros.

    Gap fill covers every bucket between the job's first and last bucket (events
    of any stage).  It needs no spine join: after the bucket aggregate, each
    bucket row emits itself plus zero rows up to (not including) the next
    non-empty bucket of its job (``lead`` over the job, ``sequence`` of longs).
    """
    step = parse_interval(interval)
    us = F.unix_micros("ts")
    agg = (base.withColumn("_b", us - F.pmod(us, F.lit(step)))
           .groupBy(*CONTEXT, "_b").agg(*timeseries_aggregations()))
    return fill_gaps(agg, step, interval)


def timeseries_aggregations() -> list:
    return [exact_sum(F.col("room_size")).alias("_sent"),
            _count_stage(STAGE_RECEIVED).alias("_received"),
            _count_stage(STAGE_RENDERED).alias("_rendered"),
            _count_stage(STAGE_FAILED).alias("_failed"),
            exact_avg(F.col("render_duration_ms")).alias("_avg")]


#: Buckets that one step of the gap fill makes of a row at most (gaps up to SPAN ** 3 buckets).
SPAN = 4096


def fill_gaps(agg: DataFrame, step: int, interval: str) -> DataFrame:
    """Non-empty bucket rows (CONTEXT, ``_b`` epoch micros, raw measures) -> gap-filled wide rows."""
    nxt = F.lead("_b").over(Window.partitionBy(*CONTEXT).orderBy("_b"))
    filled = agg.withColumns({"_from": F.col("_b"), "_last": F.coalesce(nxt - F.lit(step), F.col("_b"))})
    # a gap is a run (first, last bucket); it is cut into spans of SPAN ** 2, then SPAN buckets, and only these into buckets
    for buckets in (SPAN * SPAN, SPAN, 1):
        width = min(step * buckets, 1 << 61)
        filled = filled.withColumn("_t", F.explode(F.sequence(F.col("_from"), F.col("_last"), F.lit(width))))
        filled = filled.withColumns({"_from": F.col("_t"), "_last": F.least(F.col("_last"), F.col("_t") + F.lit(width - step))})
    real = F.col("_t") == F.col("_b")

    def keep(c, zero=0.0):
        return F.when(real, F.col(c)).otherwise(F.lit(zero))

    return filled.select(
        *_IDS, F.lit(interval).alias("interval"), F.timestamp_micros("_t").alias("time"),
        r2(keep("_sent")).alias("sent"),
        keep("_received", 0).cast("double").alias("received"),
        keep("_rendered", 0).cast("double").alias("rendered"),
        keep("_failed", 0).cast("double").alias("failed"),
        r2(F.when(real, F.col("_avg"))).alias("avgRenderMs"),
        *_INTERVAL,
    )


def timeseries(base: DataFrame, metrics: list[str] | None = None,
               interval: str = ETL_TIMESERIES_INTERVAL) -> DataFrame:
    """Long format (metric, interval, time, value); all five metrics in one pass."""
    metrics = _check_metrics(metrics)
    return timeseries_long(timeseries_wide(base, interval), metrics)


def _check_metrics(metrics: list[str] | None) -> list[str]:
    metrics = list(TIMESERIES_METRICS) if metrics is None else list(metrics)
    for m in metrics:
        if m not in TIMESERIES_METRICS:
            raise ValueError(f"{m} is no timeseries metric; there are {', '.join(TIMESERIES_METRICS)}")
    return metrics


def timeseries_from_buckets(buckets: DataFrame, interval: str = ETL_TIMESERIES_INTERVAL,
                            metrics: list[str] | None = None) -> DataFrame:
    """Long timeseries from stored non-empty bucket rows (e.g. written by a stream)."""
    return timeseries_long(fill_gaps(buckets, parse_interval(interval), interval), _check_metrics(metrics))


def timeseries_long(wide: DataFrame, metrics: list[str]) -> DataFrame:
    ids = [*_IDS, "interval", "time", *_INTERVAL]
    if len(metrics) == 1:
        return wide.select(*_IDS, F.lit(metrics[0]).alias("metric"), "interval", "time",
                           F.col(metrics[0]).alias("value"), *_INTERVAL)
    long = wide.unpivot(ids, metrics, "metric", "value")
    return long.select(*_IDS, "metric", "interval", "time", "value", *_INTERVAL)


# ---------------------------------------------------------------- A18 registry
METRIC_FUNCTIONS = {
    "platform": platform_metrics,
    "device": device_breakdown,
    "transport": transport_comparison,
    "sdk": sdk_versions,
    "failure": failure_analysis,
    "latency": lambda base: latency_nested(latency_percentiles(base)),
    "timeseries": timeseries,
}

"""Schemas and metric-table metadata.

``METRIC_META`` drives the match rollup, the accumulating sink and the
stored-metric reads: per table the unique key, the accumulated (added-up)
fields and the descending sort field.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Context columns carried by every metric row (one job = one timeline x interval).
CONTEXT = ["tenantId", "matchId", "timelineId", "intervalFrom", "intervalTo"]
JOB_KEY = CONTEXT  # the grain G of every per-job metric

# Funnel stage labels of a tracking event.
STAGE_SENT = "sent"
STAGE_RECEIVED = "received"
STAGE_RENDERED = "rendered"
STAGE_FAILED = "render-failed"

# Default ETL environment filter and the terms-bucket sizes per metric.
DEFAULT_ENVIRONMENT = "development"
TOP_PLATFORMS = 100
TOP_DEVICE_KEYS = 50
TOP_TRANSPORTS = 10
TOP_SDK_VERSIONS = 50
TOP_FAILURE_REASONS = 50
TOP_FAILURE_STEPS = 20

# Device dimension name -> event label (unknown names fall back to browser).
DEVICE_DIMENSIONS = {
    "browser": "browser",
    "os": "client_os",
    "deviceClass": "device_class",
}

# The five stored timeseries metrics and the ETL bucket interval.
TIMESERIES_METRICS = ["sent", "received", "rendered", "failed", "avgRenderMs"]
ETL_TIMESERIES_INTERVAL = "5m"

# Percentiles reported by the latency table.
LATENCY_PERCENTS = [50, 75, 95, 99]


@dataclass(frozen=True)
class MetricMeta:
    unique: tuple[str, ...]
    accumulate: tuple[str, ...]
    sort: str


# Unique key, accumulated fields and sort field per metric table.
METRIC_META: dict[str, MetricMeta] = {
    "platform": MetricMeta(("tenantId", "matchId", "platform", "intervalFrom"),
                           ("sent", "received", "rendered", "failed"), "intervalFrom"),
    "device": MetricMeta(("tenantId", "matchId", "dimension", "bucketKey", "intervalFrom"),
                         ("received", "rendered", "failed"), "intervalFrom"),
    "transport": MetricMeta(("tenantId", "matchId", "transportMode", "intervalFrom"),
                            ("count",), "intervalFrom"),
    "sdk": MetricMeta(("tenantId", "matchId", "sdkVersion", "intervalFrom"),
                      ("count",), "intervalFrom"),
    "failure": MetricMeta(("tenantId", "matchId", "failureReason", "failureStep", "intervalFrom"),
                          ("count",), "intervalFrom"),
    "timeseries": MetricMeta(("tenantId", "matchId", "metric", "interval", "time"),
                             ("value",), "time"),
    "latency": MetricMeta(("tenantId", "matchId", "intervalFrom"), (), "intervalFrom"),
}

METRIC_TYPES = list(METRIC_META)

# Flat tracking-event columns every operator reads (see sources.events).
EVENT_LABELS = [
    "timeline_id", "tenant_id", "media_content_id", "environment", "stage",
    "platform", "browser", "client_os", "device_class", "transport_mode",
    "sdk_version", "failure_reason", "failure_step",
]
EVENT_NUMERICS = ["room_size", "render_duration_ms", "receive_latency_ms", "ack_latency_ms"]

LABELS_STRUCT = T.StructType([T.StructField(n, T.StringType(), True) for n in EVENT_LABELS])
NUMERIC_STRUCT = T.StructType([T.StructField(n, T.DoubleType(), True) for n in EVENT_NUMERICS])

# Nested tracking-event document as it lands from the collector (JSON or Parquet).
TRACKING_EVENT_SCHEMA = T.StructType([
    T.StructField("@timestamp", T.TimestampType(), True),
    T.StructField("labels", LABELS_STRUCT, True),
    T.StructField("numeric_labels", NUMERIC_STRUCT, True),
])

# Job message (JSON value of the job topic).
JOB_SCHEMA = T.StructType([
    T.StructField("version", T.LongType(), True),
    T.StructField("jobType", T.StringType(), True),
    T.StructField("tenantId", T.StringType(), True),
    T.StructField("matchId", T.StringType(), True),
    T.StructField("timelineId", T.StringType(), True),
    T.StructField("timeRangeMinutes", T.DoubleType(), True),
    T.StructField("intervalFrom", T.StringType(), True),
    T.StructField("intervalTo", T.StringType(), True),
    T.StructField("retryCount", T.LongType(), True),
    T.StructField("origin", T.StringType(), True),
    T.StructField("scheduledAt", T.StringType(), True),
    T.StructField("correlationId", T.StringType(), True),
])

TARGET_SCHEMA = T.StructType([
    T.StructField("tenantId", T.StringType(), True),
    T.StructField("matchId", T.StringType(), True),
    T.StructField("timelineIds", T.ArrayType(T.StringType()), True),
    T.StructField("enabled", T.BooleanType(), True),
])

TENANT_SCHEMA = T.StructType([
    T.StructField("name", T.StringType(), True),
    T.StructField("status", T.StringType(), True),
])

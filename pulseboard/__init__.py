"""pulseboard: overlay-telemetry delivery metrics as Spark DataFrame jobs.

Layout
------
sources/    event, job-message, dimension and metric-store readers
functions/  column expressions (rounding, rates, keys, time buckets)
operators/  metric aggregations, predicates, top-k, realtime views, rollups
plans/      job expansion / validation / range join, all-metrics runs, sinks
streaming/  Structured Streaming versions of the metrics and the sinks
"""

__version__ = "0.1.0"

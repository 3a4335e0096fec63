"""Repeated and late events of a stream (ST1, ST2, K2).

A repeat within the watermark's delay is dropped by its event id.  An event behind the watermark is dropped by the
windowed metrics; here it becomes a backfill request for the job that it belongs to, so the stored
metrics equal those of a batch run once the requests are worked off (``plans.etl.backfill``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseboard.operators.context import grid_context
from pulseboard.streaming.ledger import Ledger


def drop_repeats(events: DataFrame, watermark: str = "10 minutes") -> DataFrame:
    """Events once per event id, in a batch over the whole table and in a stream within the watermark.

    Events without an id are kept all: nothing tells a repeat from a second event.  A repeat has the content
    of the event it repeats.  A stream also drops what is behind its watermark (see :func:`late_event_sink`).
    """
    known, unknown = events.where("event_id IS NOT NULL"), events.where("event_id IS NULL")
    if not events.isStreaming:
        return known.dropDuplicates(["event_id"]).unionByName(unknown)
    return (known.withWatermark("ts", watermark).dropDuplicatesWithinWatermark(["event_id"])
            .unionByName(unknown.withWatermark("ts", watermark)))


def late_event_sink(path: str, *, environment: str | None, delay_minutes: float = 10, job_minutes: int = 60,
                    reads_ahead: bool = True):
    """foreachBatch function on the raw events: backfill requests for the jobs of late events, below ``path``.

    An event is late where it lies ``delay_minutes`` or more behind the latest time of the batches before.  Where the metrics
    stream may cut its batches elsewhere (``reads_ahead``), times of the same batch count too: that
    names every job which that stream can have missed, and some it has not; a backfill replaces jobs whole, so those stay right.
    Requests lie in one folder a batch, which a replay rewrites.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        ledger = Ledger(spark, path)
        before = ledger.mark_before(batch_id)
        newest = batch.agg(F.unix_micros(F.max("ts"))).first()[0]
        high = max((m for m in (before, newest) if m is not None), default=None)
        limit = high if reads_ahead else before
        if limit is not None:
            behind = batch.where(F.unix_micros("ts") <= F.lit(limit - round(delay_minutes * 60_000_000)))
            iso = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
            (grid_context(behind, job_minutes, environment=environment)
             .select("tenantId", "matchId", "timelineId", "intervalFrom", "intervalTo").distinct()
             .select("tenantId", "matchId", F.array("timelineId").alias("timelineIds"),
                     F.date_format("intervalFrom", iso).alias("intervalFrom"),
                     F.date_format("intervalTo", iso).alias("intervalTo"), F.lit(batch_id).cast("long").alias("batchId"))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batchId").parquet(path))
        ledger.commit(batch_id, high)
    return run


def late_requests(spark, path: str) -> DataFrame:
    """The requests of all batches, each job once; no rows where nothing was late."""
    schema = "tenantId string, matchId string, timelineIds array<string>, intervalFrom string, intervalTo string, batchId bigint"
    if not Ledger.exists(spark, path):
        return spark.createDataFrame([], schema).drop("batchId")
    return spark.read.schema(schema).parquet(path).drop("batchId").distinct()

"""Streaming sinks (ST3, ST4).

``foreachBatch`` applies the batch upsert of ``plans.store`` to every
micro-batch.  The stream's checkpoint replays a batch after a failure with the
same ``batchId``; the sink is idempotent (row replacement), and a
ledger next to the table skips the batch that was committed last.
"""

from __future__ import annotations

from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseboard.plans import jobs as JB
from pulseboard.plans import store as ST
from pulseboard.session import cut_lineage
from pulseboard.streaming.ledger import Ledger


def metric_upsert_sink(path: str, metric_type: str, mode: str = "idempotent", truncate=None):
    """foreachBatch function: merge the micro-batch rows into the table at ``path``.

    ``truncate`` applies the per-job top-N to the full contribution rows before
    the match table is derived (see ``streaming.windowed.platform_top_n``).
    Windowed streams emit running totals, and a replayed batch comes twice: adding them up is refused.
    """
    if mode != "idempotent":
        raise ValueError(f"a stream's rows replace earlier ones; mode {mode!r} would add them up")

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        ledger = Ledger(spark, path)
        if ledger.last() == batch_id:
            return
        ST.upsert_table(spark, path, batch, metric_type, mode=mode, replace_by="row", truncate=truncate)
        ledger.commit(batch_id)
    return run


def buckets_sink(path: str):
    """foreachBatch function for raw timeseries buckets: replace by (job, bucket)."""
    keys = ["tenantId", "matchId", "timelineId", "intervalFrom", "_b"]

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        new = batch.withColumn("intervalDate", F.to_date("intervalFrom"))
        touched = new.select("tenantId", "intervalDate").distinct()
        old = ST.read_partitions(spark, path, touched, batch)
        merged = new.drop("intervalDate")
        if old is not None:
            merged = old.join(merged.select(*keys), keys, "left_anti").unionByName(merged)
        merged = cut_lineage(merged.withColumn("intervalDate", F.to_date("intervalFrom")))
        (merged.hint("rebalance", "tenantId", "intervalDate").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("tenantId", "intervalDate").parquet(path))
    return run


def job_validation_sink(valid_path: str, dlq_path: str, failed_at: datetime | str):
    """ST4: validate a micro-batch of job messages once and write both outputs.

    Each output is partitioned by ``batchId`` and overwritten per batch, so a
    replayed batch rewrites its own folder instead of appending twice.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        checked = JB.validate_jobs(batch).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for df, path in ((checked.where("is_valid"), valid_path),
                             (JB.dead_letters(checked, failed_at), dlq_path)):
                (df.withColumn("batchId", F.lit(batch_id).cast("long")).write.mode("overwrite")
                 .option("partitionOverwriteMode", "dynamic").partitionBy("batchId").parquet(path))
        finally:
            checked.unpersist()
    return run


def run_available_now(df: DataFrame, sink, checkpoint: str, output_mode: str = "update") -> None:
    """Drive a stream over everything available, then stop (no ports, no servers)."""
    q = (df.writeStream.outputMode(output_mode).foreachBatch(sink)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))

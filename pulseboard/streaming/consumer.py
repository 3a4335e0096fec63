"""The job consumer as a stream (S7 -> P7/P8 -> T1 -> J2 -> A18 -> S4, rejects -> S8).

The reference consumes one job message at a time, validates it, resolves its
interval, runs the seven metric queries for it and upserts the rows.  Here a
micro-batch of messages is handled at once: validation and dead letters for
the whole batch, one range join of all valid jobs with the events, and one
all-metrics run into the store.  If a metric fails, the batch's jobs go to the dead letters with the
error, and the stream goes on.  Replaying a batch is harmless: dead letters
are overwritten per batch id and the store upsert is idempotent.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseboard.plans import etl as ETL
from pulseboard.plans import jobs as JB


def job_consumer_sink(events: DataFrame, store_root: str, dlq_path: str,
                      clock: Callable[[int], datetime | str], *, environment: str | None) -> Callable[[DataFrame, int], None]:
    """foreachBatch function.  ``clock(batch_id)`` gives the processing time used
    for interval alignment, audit times and ``failedAt`` (a parameter, never read inside a
    query); ``environment`` is the deployment's own (null: events of all)."""
    def write_dead_letters(checked: DataFrame, now: datetime | str, batch_id: int) -> None:
        (JB.dead_letters(checked, now).withColumn("batchId", F.lit(batch_id).cast("long"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batchId").parquet(dlq_path))

    def run(batch: DataFrame, batch_id: int) -> None:
        now = clock(batch_id)
        checked = JB.validate_jobs(batch).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            write_dead_letters(checked, now, batch_id)
            jobs = JB.valid_jobs(checked, now)
            if jobs.limit(1).count() == 0:
                return
            base = JB.jobs_join_events(jobs, events, environment=environment)
            try:
                ETL.run_all(batch.sparkSession, base, store_root, jobs=jobs, now=now)
            except ETL.MetricRunError as e:
                text = "; ".join([str(e), *(f"{m}: {t.splitlines()[0]}" for m, t in sorted(e.failures.items()))])
                failed = checked.where("is_valid").withColumns({"is_valid": F.lit(False), "error_message": F.lit(text)})
                rejected = checked.where("NOT is_valid")
                write_dead_letters(rejected.unionByName(failed), now, batch_id)
        finally:
            checked.unpersist()
    return run

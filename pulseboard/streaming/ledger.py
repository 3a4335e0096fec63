"""What a sink remembers between micro-batches: the last batch and a time mark (ST3).

Two one-row folders take turns, so the ledger of a sink never grows, and a write that is cut off leaves the
batch before readable.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from pulseboard.plans import store as ST

SCHEMA = "batchId bigint, mark bigint, slot int"


class Ledger:
    def __init__(self, spark: SparkSession, table: str):
        self.spark = spark
        self.path = table.rstrip("/") + "_ledger"

    @staticmethod
    def exists(spark: SparkSession, path: str) -> bool:
        return ST._exists(spark, path)

    def _rows(self) -> list:
        if not self.exists(self.spark, self.path):
            return []
        return self.spark.read.schema(SCHEMA).parquet(self.path).select("batchId", "mark").collect()  # two rows at most

    def last(self) -> int | None:
        """The batch committed last.  A stream repeats no batch but that one."""
        return max((r["batchId"] for r in self._rows()), default=None)

    def mark_before(self, batch_id: int) -> int | None:
        """The mark as it stood before ``batch_id``, also where that batch is repeated."""
        rows = [r for r in self._rows() if r["batchId"] < batch_id]
        return max(rows, key=lambda r: r["batchId"])["mark"] if rows else None

    def commit(self, batch_id: int, mark: int | None = None) -> None:
        row = self.spark.range(1).select(F.lit(batch_id).cast("long").alias("batchId"), F.lit(mark).cast("long").alias("mark"),
                                         F.lit(batch_id % 2).alias("slot"))
        (row.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("slot").parquet(self.path))

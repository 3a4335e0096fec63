"""Top-N buckets per group (terms-aggregation size limits).

Order is row count descending, key ascending - exact, where the search store
is shard-approximate.  ``row_number() <= N`` is planned as a WindowGroupLimit,
so a partial top-N runs before the window's shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_n_per_group(df: DataFrame, group_cols: list[str], count_col: str, key_col: str,
                    n: int | None) -> DataFrame:
    if n is None:
        return df
    if n <= 0:
        raise ValueError("top-N size must be positive")
    w = Window.partitionBy(*group_cols).orderBy(F.desc(count_col), F.asc(key_col))
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= n).drop("_rank")

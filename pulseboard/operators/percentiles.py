"""Exact percentiles and stats by selection over value counts (A8-A10); one path for groups of every size.

Spark's ``percentile`` merges a group's whole value->count map in one task.  Here a group is only ever met as counts:

1. (group, value) counts, combined before the shuffle: equal values of a hot group are one row from there on;
2. a histogram per group over cells, an order-preserving coarse key of the value (``CELLS`` per factor e), and its running
   counts: they say which cells hold the wanted ranks;
3. only the counts of those cells are read again, and running counts inside a cell give the value at each rank.

So what a group brings into one task is its histogram (a few thousand rows for latencies, whatever the number of
events), and of its values those that lie within a thousandth of a wanted one.  Percentiles are linear interpolation
between the values at ranks floor((n-1)p) and ceil((n-1)p), term for term as in Spark's ``percentile``.

Null, NaN, infinite and immeasurably large values count nowhere: not in n, sum, extremes or percentiles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulseboard.functions.numeric import MEASURED_BELOW

#: Cells per factor e of the value: a cell is a thousandth wide.
CELLS = 1024


def finite(x: Column) -> Column:
    """``x`` as a double, null unless it is a measurement."""
    x = x.cast("double")
    return F.when(F.abs(x) < MEASURED_BELOW, x)


def cell_of(v: Column) -> Column:
    """Coarse key of a value; never falls as the value rises."""
    return (F.signum(v) * F.floor(F.log1p(F.abs(v)) * CELLS)).cast("long")


def value_counts(df: DataFrame, keys: Sequence[str], value: Column, sums: dict[str, Column] | None = None) -> DataFrame:
    """``keys``, ``_v``, ``_c`` (rows) and the summed columns: one row per group and distinct value, null included."""
    extra = [F.sum(c).alias(n) for n, c in (sums or {}).items()]
    return df.groupBy(*keys, finite(value).alias("_v")).agg(F.count(F.lit(1)).alias("_c"), *extra)


def distribution(counts: DataFrame, keys: Sequence[str], percents: Sequence[float], sums: Sequence[str] = ()) -> DataFrame:
    """One row per group of ``counts`` (keys, _v, _c, and ``sums``): keys, n, total (decimal), avg, least, most, rows,
    the ``sums`` added up, and p0, p1, ... (null for a group without values)."""
    keys, valid = list(keys), F.col("_v").isNotNull()
    counts = counts.withColumn("_cell", cell_of(F.col("_v")))
    weight = F.when(valid, F.col("_c"))
    hist = counts.groupBy(*keys, "_cell").agg(
        F.coalesce(F.sum(weight), F.lit(0)).alias("_n"), F.sum(F.col("_v").cast("decimal(38,6)") * F.col("_c")).alias("_t"),
        F.min("_v").alias("_lo_v"), F.max("_v").alias("_hi_v"), F.sum("_c").alias("_rows"), *[F.sum(s).alias(s) for s in sums])
    group = Window.partitionBy(*keys)
    before = group.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    hist = hist.withColumns({
        "_off": F.coalesce(F.sum("_n").over(before), F.lit(0)), "n": F.sum("_n").over(group), "total": F.sum("_t").over(group),
        "least": F.min("_lo_v").over(group), "most": F.max("_hi_v").over(group), "rows": F.sum("_rows").over(group),
        "_first": F.row_number().over(group.orderBy("_cell")) == 1, **{s: F.sum(s).over(group) for s in sums}})
    rank = {}
    for i, p in enumerate(percents):
        at = (F.col("n") - 1).cast("double") * F.lit(float(p))
        rank[i] = (at, F.floor(at), F.ceil(at))
    inside = F.lit(False)
    for _, lo, hi in rank.values():
        for r in (lo, hi):
            inside = inside | ((r >= F.col("_off")) & (r < F.col("_off") + F.col("_n")))
    # one row of every group stays, also of one without values
    wanted = hist.where(inside | F.col("_first")).select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_cell").alias("_at"), "_off", "n", "total", "least", "most", "rows", *sums)
    same = F.col("_cell") == F.col("_at")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    hit = wanted.join(counts.where(valid).select(*keys, "_cell", "_v", "_c"), same, "left")
    names = [f"_k{i}" for i in range(len(keys))]
    run = Window.partitionBy(*names, "_at").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hit = hit.withColumn("_end", F.col("_off") + F.sum("_c").over(run)).withColumn("_start", F.col("_end") - F.col("_c"))

    def at_rank(r: Column) -> Column:
        return F.max(F.when((r >= F.col("_start")) & (r < F.col("_end")), F.col("_v")))

    found = hit.groupBy(*names).agg(
        *[F.max(c).alias(c) for c in ("n", "total", "least", "most", "rows", *sums)],
        *[at_rank(lo).alias(f"_a{i}") for i, (_, lo, _) in rank.items()], *[at_rank(hi).alias(f"_b{i}") for i, (_, _, hi) in rank.items()])

    def percentile(i: int) -> Column:
        at, lo, hi = rank[i]
        a, b = F.col(f"_a{i}"), F.col(f"_b{i}")
        return F.when((lo == hi) | (a == b), a).otherwise((hi.cast("double") - at) * a + (at - lo.cast("double")) * b)

    return found.select(*[F.col(f"_k{i}").alias(k) for i, k in enumerate(keys)], "n", "total",
                        F.when(F.col("n") > 0, F.col("total").cast("double") / F.col("n")).alias("avg"), "least", "most", "rows", *sums,
                        *[percentile(i).alias(f"p{i}") for i in rank])


def distributed_percentiles(df: DataFrame, group_cols: list[str], value_col: str, percents: list[float], prefix: str = "p") -> DataFrame:
    """``group_cols`` + one raw percentile column per percent (``{prefix}{i}``); groups without values are absent."""
    found = distribution(value_counts(df, group_cols, F.col(value_col)), group_cols, percents)
    return found.where("n > 0").select(*group_cols, *[F.col(f"p{i}").alias(f"{prefix}{i}") for i in range(len(percents))])

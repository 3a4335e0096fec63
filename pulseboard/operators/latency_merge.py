"""Match latency from stored rows: mergeable histograms of value cells (A8, A15), no event scan.

A job's latency percentiles cannot be combined into its match's.  Its histogram can: per series the counts of the cells of
``operators.percentiles`` (``CELLS`` per factor e), with exact n, sum and maximum.  Histograms add up cell by cell, in any
order and to the same result, so a match is the sum of its jobs' stored rows.

What is exact: n, average, maximum.  A percentile is interpolated between cell middles, so of a value x >= 0 it is off by
no more than ERROR * (x + 1); ranks are not approximated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulseboard.operators import metrics as M
from pulseboard.operators.percentiles import CELLS, cell_of, value_counts
from pulseboard.schema import CONTEXT, LATENCY_PERCENTS

#: Half the relative width of a cell, as a bound on a percentile's error in (value + 1).
ERROR = 0.5 / CELLS + 1e-6


def latency_histograms(base: DataFrame) -> DataFrame:
    """One stored row per job and series: CONTEXT, series, cells (array of cell, n; ascending), n, total, most."""
    series = F.array(*[F.struct(F.lit(n).alias("series"), F.col(c).alias("_x")) for n, c in M.LATENCY_SERIES.items()])
    long = base.select(*CONTEXT, F.inline(series))
    return histograms_from_counts(value_counts(long, [*CONTEXT, "series"], F.col("_x")))


def histograms_from_counts(counts: DataFrame) -> DataFrame:
    """The rows from value counts (CONTEXT, series, _v, _c); a series without values has a row of no cells."""
    keys, some = [*CONTEXT, "series"], F.col("_v").isNotNull()
    cells = counts.groupBy(*keys, cell_of(F.col("_v")).alias("cell")).agg(
        F.sum(F.when(some, F.col("_c")).otherwise(0)).alias("n"), F.sum(F.col("_v").cast("decimal(38,6)") * F.col("_c")).alias("total"), F.max("_v").alias("most"))
    # a histogram has a row's size: its cells are bounded by the range of the values, not by the events
    return cells.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.when(F.col("cell").isNotNull(), F.struct("cell", "n")))).alias("cells"),
        F.sum("n").alias("n"), F.sum("total").cast("decimal(38,6)").alias("total"), F.max("most").alias("most"))


def merge_latency(histograms: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Flat latency columns per group of ``keys`` (default: match and interval) from stored histograms of its jobs.

    Null cells do not occur; a group whose jobs hold no value of a series has zeros, as a job without events has."""
    keys = ["tenantId", "matchId", "intervalFrom", "intervalTo"] if keys is None else list(keys)
    by = [*keys, "series"]
    sums = histograms.groupBy(*by).agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.max("most").alias("most"))
    cells = histograms.select(*by, F.inline_outer("cells")).where("cell IS NOT NULL").groupBy(*by, "cell").agg(F.sum("n").alias("c"))
    group = Window.partitionBy(*by)  # the rows of a group are its cells
    cells = cells.withColumns({"end": F.sum("c").over(group.orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)), "all": F.sum("c").over(group)})
    magnitude = F.expm1((F.abs("cell") + 0.5) / CELLS)
    middle = F.when(F.col("cell") < 0, -magnitude).when(F.col("cell") > 0, magnitude).otherwise(0.0)

    def at_rank(r):
        return F.max(F.when((r >= F.col("end") - F.col("c")) & (r < F.col("end")), middle))

    at = {p: (F.col("all") - 1).cast("double") * (p / 100.0) for p in LATENCY_PERCENTS}
    ranks = cells.groupBy(*by).agg(F.max("all").alias("all"), *[at_rank(F.floor(a)).alias(f"lo{p}") for p, a in at.items()], *[at_rank(F.ceil(a)).alias(f"hi{p}") for p, a in at.items()])
    points = ranks.select(*by, *[(F.col(f"lo{p}") + (a - F.floor(a)) * (F.col(f"hi{p}") - F.col(f"lo{p}"))).alias(f"p{p}") for p, a in at.items()])
    rows = sums.join(points, by, "left")
    of = lambda s, c: F.max(F.when(F.col("series") == s, c))
    aggs = []
    for s in M.LATENCY_SERIES:
        aggs += [of(s, F.col("total").cast("double") / F.nullif(F.col("n"), F.lit(0))).alias(f"{s}_avg_raw"), of(s, F.col("most")).alias(f"{s}_max_raw")]
        # no percentile lies beyond the greatest value
        aggs += [of(s, F.least(F.col(f"p{p}"), F.col("most"))).alias(f"{s}_p{p}_raw") for p in LATENCY_PERCENTS]
    return M.derive_latency_flat(rows.groupBy(*keys).agg(*aggs), keys)

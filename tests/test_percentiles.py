"""The exact percentile by selection equals Spark's percentile, also for a hot group spread over partitions."""

import random

from pyspark.sql import functions as F

from conftest import SF0001, make_events
from pulseboard.functions.numeric import r2
from pulseboard.operators import metrics as M
from pulseboard.operators import one_scan
from pulseboard.operators.context import grid_context
from pulseboard.operators.percentiles import distributed_percentiles, distribution, value_counts
from pulseboard.session import cut_lineage, ensure_checkpoint_dir
from pulseboard.sources.events import fixture_events


def test_distributed_equals_builtin_on_a_hot_group(spark):
    ensure_checkpoint_dir(spark)
    rnd = random.Random(7)
    rows = [("hot", round(rnd.uniform(0, 500), 2)) for _ in range(5000)]
    rows += [("cold", float(v)) for v in (3.0, 1.0, 2.0)] + [("one", 4.5)] + [("dups", 2.0)] * 4 + [("dups", 9.0)]
    rows += [("nulls", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    ps = [0.5, 0.75, 0.95, 0.99, 0.0, 1.0]
    got = {r["g"]: [r[f"p{i}"] for i in range(len(ps))]
           for r in distributed_percentiles(df, ["g"], "v", ps).collect()}
    exp = {r["g"]: list(r["p"]) for r in df.groupBy("g").agg(
        F.percentile("v", F.array(*[F.lit(p) for p in ps])).alias("p")).collect() if r["p"] is not None}
    assert got == exp and "nulls" not in got


def test_percentiles_of_awkward_values(spark):
    """Negative, tiny, huge and repeated values, values of one cell, and numbers that are no measurements."""
    rnd = random.Random(3)
    nan, inf = float("nan"), float("inf")
    groups = {"mixed": [-1e9, -3.5, -1e-9, 0.0, -0.0, 1e-300, 1e-9, 2.0, 1e12, 1e29], "close": [100 + k / 1e9 for k in range(500)],
              "signed": [rnd.gauss(0, 1) for _ in range(800)], "one": [7.0], "bad": [100.0, nan, 1e31, 200.0, inf, -inf, None], "none": [None, nan]}
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "g string, v double").repartition(5)
    ps = [0.0, 0.01, 0.5, 0.75, 0.95, 0.99, 1.0]
    ok = df.where("NOT isnan(v) AND abs(v) < 1e30")
    want = {r["g"]: r for r in ok.groupBy("g").agg(F.percentile("v", F.array(*[F.lit(p) for p in ps])).alias("p"), F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("v").alias("n")).collect()}
    got = {r["g"]: r for r in distribution(value_counts(df, ["g"], F.col("v")), ["g"], ps).collect()}
    assert sorted(got) == sorted(groups) and got["none"]["n"] == 0 and got["none"]["p0"] is None and got["none"]["rows"] == 2
    for g, w in want.items():
        assert [got[g][f"p{i}"] for i in range(len(ps))] == w["p"] and (got[g]["least"], got[g]["most"], got[g]["n"]) == (w["lo"], w["hi"], w["n"])
    assert got["bad"]["avg"] == 150.0 and got["bad"]["rows"] == 7


def test_one_rule_for_numbers_that_are_no_measurements(spark):
    """Sum, average, extremes and percentiles leave out the same values (latency 100, NaN, 1e31, 200)."""
    ev = make_events(spark, [{"stage": "received", "receive_latency_ms": x} for x in (100.0, float("nan"), 1e31, 200.0)])
    row = M.latency_percentiles(grid_context(ev, 60, environment="development")).first()
    assert (row["receive_avg"], row["receive_max"], row["receive_p50"], row["receive_p95"]) == (150.0, 200.0, 150.0, 195.0)


def test_rounding_keeps_large_numbers(spark):
    big = [9.1e16, 2.0**53, -4e17, 1e29, 90071992547409.92, 12345678901.239]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in big], "x double").select(r2(F.col("x"))).collect()]
    assert got == [9.1e16, 2.0**53, -4e17, 1e29, 90071992547409.92, 12345678901.24]
    assert [r[0] for r in spark.createDataFrame([(x,) for x in big], "x double").select(r2("x")).collect()] == got


def test_global_group_and_empty_input(spark):
    one = spark.createDataFrame([(float(v),) for v in range(10)], "receive_latency_ms double") \
        .selectExpr("receive_latency_ms", "CAST(NULL AS DOUBLE) AS render_duration_ms", "CAST(NULL AS DOUBLE) AS ack_latency_ms")
    b = M.latency_aggregates(one, group_cols=[], with_stats=True).collect()[0]
    assert abs(b["receive_p95_raw"] - 8.55) < 1e-9 and b["render_p50_raw"] is None and b["render_count"] == 0 and b["receive_sum_raw"] == 45.0
    none = M.latency_aggregates(one.limit(0), group_cols=[]).collect()
    assert len(none) == 1 and none[0]["receive_p50_raw"] is None


def test_hot_group_is_met_as_counts_only(spark):
    """Partial counts stand before every shuffle of values, and no built-in percentile gathers a group."""
    plan = M.latency_percentiles(grid_context(fixture_events(spark, SF0001), 1440, environment="development"))._jdf.queryExecution().executedPlan().toString()
    assert "percentile(" not in plan and "partial_count" in plan


def test_one_scan_equals_the_single_metrics(spark):
    base = grid_context(fixture_events(spark, SF0001), 1440, environment="development")
    pre = cut_lineage(one_scan.pre_aggregate(base))
    for name, fn in M.METRIC_FUNCTIONS.items():
        a, b = one_scan.TABLES[name](pre), fn(base)
        assert a.columns == b.columns and a.dtypes == b.dtypes
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect())), name
    assert "Scan parquet" not in pre._jdf.queryExecution().executedPlan().toString()

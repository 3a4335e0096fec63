"""Property tests: batching + idempotent sink = one run; distributed percentile = built-in."""

import uuid

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF0001
from pulseboard.operators import metrics as M
from pulseboard.operators.context import grid_context
from pulseboard.operators.percentiles import distributed_percentiles
from pulseboard.plans import store as ST
from pulseboard.session import ensure_checkpoint_dir
from pulseboard.sources.events import fixture_events


def _table(spark, path):
    return sorted(tuple(r) for r in spark.read.parquet(path).drop("intervalDate").collect())


def test_split_batches_and_replay_equal_one_run(spark):
    ck = ensure_checkpoint_dir(spark)
    ev = fixture_events(spark, SF0001)
    cut = F.col("ts") < F.lit("2024-01-15 00:00:00").cast("timestamp")
    one, split = f"{ck}/prop-one-{uuid.uuid4().hex}", f"{ck}/prop-split-{uuid.uuid4().hex}"
    ST.upsert_table(spark, one, M.platform_metrics(grid_context(ev, 1440, environment="development")), "platform")
    first = M.platform_metrics(grid_context(ev.where(cut), 1440, environment="development"))
    second = M.platform_metrics(grid_context(ev.where(~cut), 1440, environment="development"))
    for rows in (first, second, first):          # the first batch is replayed at the end
        ST.upsert_table(spark, split, rows, "platform")
    assert _table(spark, one) == _table(spark, split)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]),
                          st.integers(min_value=0, max_value=40).map(lambda v: v / 4)),
                min_size=1, max_size=60),
       st.integers(min_value=1, max_value=5))
def test_distributed_percentile_equals_builtin(spark, rows, parts):
    ensure_checkpoint_dir(spark)
    df = spark.createDataFrame(rows, "g string, v double").repartition(parts)
    ps = [0.5, 0.95, 0.99]
    got = {r["g"]: [r["p0"], r["p1"], r["p2"]]
           for r in distributed_percentiles(df, ["g"], "v", ps).collect()}
    exp = {r["g"]: list(r["p"]) for r in
           df.groupBy("g").agg(F.percentile("v", F.array(*[F.lit(p) for p in ps])).alias("p")).collect()}
    assert got == exp

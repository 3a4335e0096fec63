"""Scalar expressions (golden values from the reference's math tests)."""

import math

import pytest
from pyspark.sql import functions as F

from pulseboard.functions import calc_rate, key_or_unknown, parse_interval, r2, rate
from pulseboard.functions.time import bucket_start


def _eval(spark, col, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(col).collect()]


def test_r2_edge_values(spark):
    xs = [None, math.nan, math.inf, -math.inf, 0.0, 123.456, 0.005, -99.999, 2.0 ** 53 - 1, 4.9e-324]
    got = _eval(spark, r2("x"), [(x,) for x in xs], "x double")
    assert got == [0.0, 0.0, 0.0, 0.0, 0.0, 123.46, 0.01, -100.0, 2.0 ** 53 - 1, 0.0]


def test_r2_is_half_up_not_half_away():
    # documents why F.round is not used: JS rounds -0.005 -> -0 (== 0), F.round gives -0.01
    assert math.floor(-0.005 * 100 + 0.5) / 100 == 0.0


def test_rate_edge_values(spark):
    pairs = [(50.0, 100.0), (150.0, 100.0), (-50.0, 100.0), (100.0, 0.0), (100.0, None), (1.0, 3.0),
             (0.1, 0.3), (5.0, math.nan)]
    got = _eval(spark, rate("n", "d"), pairs, "n double, d double")
    assert got == [50.0, 150.0, -50.0, 0.0, 0.0, 33.33, 33.33, 0.0]


def test_calc_rate(spark):
    got = _eval(spark, calc_rate("n", "d"), [(1.0, 3.0), (2.0, 3.0), (5.0, 0.0)], "n double, d double")
    assert got == [33.33, 66.67, 0.0]


def test_key_default(spark):
    got = _eval(spark, key_or_unknown("k"), [("web",), ("",), (None,)], "k string")
    assert got == ["web", "unknown", "unknown"]


@pytest.mark.parametrize("text,micros", [("5m", 300_000_000), ("1m", 60_000_000), ("1h", 3_600_000_000),
                                         ("30s", 30_000_000), ("250ms", 250_000), ("1d", 86_400_000_000)])
def test_interval_grammar(text, micros):
    assert parse_interval(text) == micros


@pytest.mark.parametrize("bad", ["5 minutes", "m", "", "0m", "5w", "-5m"])
def test_interval_grammar_rejects(bad):
    with pytest.raises(ValueError):
        parse_interval(bad)


def test_bucket_is_epoch_aligned(spark):
    df = spark.createDataFrame([("2026-05-13 10:07:59",), ("2026-05-13 10:08:00",)], "s string") \
        .select(F.col("s").cast("timestamp").alias("ts"))
    # 7-minute buckets are aligned to the UTC epoch, not to the hour
    epoch_min = [r[0] for r in df.select((F.unix_seconds(bucket_start("ts", 7 * 60_000_000)) / 60) % 7).collect()]
    assert epoch_min == [0.0, 0.0]

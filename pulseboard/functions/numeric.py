"""Scalar column expressions shared by every metric (all JVM-side built-ins).

Rounding follows the reference's ``Math.round(x * 100) / 100``: half towards
+infinity on the binary double.  ``F.round`` rounds half away from zero, which
differs for negative halves (-0.005 -> -0.01 instead of 0), so the floor form
is used here and in the oracle SQL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_INF = float("inf")
#: From here on a double has no third decimal to round, and its hundredfold leaves the range in which doubles are exact.
WHOLE_FROM = 2.0**53 / 100


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Each function accepts Columns, or SQL expression text (a column name is one).
# With text the whole expression is built by one ``F.expr`` call, which keeps
# plan construction cheap for the many derived columns of a metric row.

def r2_sql(x: str) -> str:
    d = f"CAST(({x}) AS DOUBLE)"
    return (f"(CASE WHEN {d} IS NULL OR isnan({d}) OR abs({d}) = CAST('Infinity' AS DOUBLE) THEN 0D "
            f"WHEN abs({d}) >= {WHOLE_FROM!r}D THEN {d} ELSE floor({d} * 100 + 0.5) / 100 END)")


def rate_sql(n: str, d: str) -> str:
    dd = f"CAST(({d}) AS DOUBLE)"
    return f"(CASE WHEN {dd} > 0 THEN {r2_sql(f'CAST(({n}) AS DOUBLE) / {dd} * 100')} ELSE 0D END)"


def calc_rate_sql(n: str, d: str) -> str:
    dd = f"CAST(({d}) AS DOUBLE)"
    return f"(CASE WHEN {dd} > 0 THEN floor(CAST(({n}) AS DOUBLE) / {dd} * 10000 + 0.5) / 100 ELSE 0D END)"


def r2(x) -> Column:
    """Normalise a number: null / NaN / +-Infinity -> 0, else round to 2 decimals."""
    if isinstance(x, str):
        return F.expr(r2_sql(x))
    x = x.cast("double")
    bad = x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(_INF))
    return F.when(bad, F.lit(0.0)).when(F.abs(x) >= WHOLE_FROM, x).otherwise(F.floor(x * 100 + 0.5) / 100)


def rate(n, d) -> Column:
    """Percentage n/d*100 normalised by r2; a non-positive or null denominator gives 0.

    The division sits inside the ``when`` branch, so a zero denominator is never
    evaluated (ANSI mode would raise on it).
    """
    if isinstance(n, str) and isinstance(d, str):
        return F.expr(rate_sql(n, d))
    n, d = _col(n).cast("double"), _col(d).cast("double")
    return F.when(d > 0, r2(n / d * 100)).otherwise(F.lit(0.0))


def calc_rate(n, d) -> Column:
    """Realtime funnel rate: round(n/d*10000)/100 with the same half-up rule."""
    if isinstance(n, str) and isinstance(d, str):
        return F.expr(calc_rate_sql(n, d))
    n, d = _col(n).cast("double"), _col(d).cast("double")
    return F.when(d > 0, F.floor(n / d * 10000 + 0.5) / 100).otherwise(F.lit(0.0))


def key_or_unknown(c) -> Column:
    """Bucket key default: null or empty string -> 'unknown' (one bucket for both)."""
    return F.coalesce(F.nullif(_col(c).cast("string"), F.lit("")), F.lit("unknown"))


def stage_is(stage: str) -> Column:
    return F.col("stage") == F.lit(stage)


#: Numbers of this size or more, NaN and the infinities are not measurements: they are neither summed nor counted.
MEASURED_BELOW = 1e30


def measured(x) -> Column:
    """``x`` as a number that an exact sum can hold, else null."""
    x = _col(x).cast("double")
    return F.when(F.abs(x) < MEASURED_BELOW, x).cast("decimal(38,6)")


def exact_sum(x) -> Column:
    """Sum that does not depend on the order of additions (see :func:`exact_avg`); null when no value is present."""
    return F.sum(measured(x)).cast("double")


def exact_avg(x) -> Column:
    """Average whose value does not depend on partitioning or summation order.

    A double sum changes with the order of additions, and a later 2-decimal
    rounding can flip on it.  Summing a DECIMAL(38,6) is exact and associative,
    so every partitioning (and DuckDB) gives the same bits.  Values carry at most
    6 fractional digits in the inputs (milliseconds).  Null when no value is present.
    """
    n = F.count(measured(x))
    return F.when(n > 0, exact_sum(x) / n)

"""Time helpers: epoch-aligned buckets and the interval grammar."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unit suffixes of a fixed interval string and their length in microseconds.
_UNIT_MICROS = {
    "ms": 1_000,
    "s": 1_000_000,
    "m": 60_000_000,
    "h": 3_600_000_000,
    "d": 86_400_000_000,
}
_INTERVAL_RE = re.compile(r"^(\d+)(ms|s|m|h|d)$")


def parse_interval(interval: str) -> int:
    """'5m' -> microseconds.  Raises ValueError on anything else (e.g. '5 minutes', '0m')."""
    m = _INTERVAL_RE.match(interval or "")
    if not m or int(m.group(1)) <= 0:
        raise ValueError(f"Unsupported interval: {interval!r}")
    return int(m.group(1)) * _UNIT_MICROS[m.group(2)]


def interval_micros(minutes: float) -> int:
    micros = int(round(minutes * 60_000_000))
    if micros <= 0:
        raise ValueError(f"interval must be positive, got {minutes} minutes")
    return micros


def bucket_start(ts, step_micros: int) -> Column:
    """UTC-epoch aligned floor of a timestamp to a multiple of ``step_micros``.

    Pure integer arithmetic on epoch microseconds (pmod keeps pre-1970 values
    aligned too); stays inside whole-stage codegen.
    """
    ts = F.col(ts) if isinstance(ts, str) else ts
    us = F.unix_micros(ts)
    return F.timestamp_micros(us - F.pmod(us, F.lit(step_micros)))

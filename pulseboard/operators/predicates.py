"""Predicate builders.

Each query object compiles to ONE boolean ``Column`` so Catalyst can push the
equality / IN / range parts into the Parquet scan (PushedFilters).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from pulseboard.schema import DEFAULT_ENVIRONMENT

USE_DEFAULT: Any = object()  # marker: environment not given -> configured default


def to_utc(value) -> datetime | None:
    """ISO-8601 string / datetime -> naive UTC datetime (None passes through)."""
    if value is None or value == "":
        return None
    if isinstance(value, datetime):
        dt = value
    else:
        s = str(value).strip()
        if s.endswith("Z"):
            s = s[:-1] + "+00:00"
        dt = datetime.fromisoformat(s)
    if dt.tzinfo is not None:
        dt = dt.astimezone(timezone.utc).replace(tzinfo=None)
    return dt


def ts_lit(value) -> Column:
    dt = to_utc(value)
    return F.lit(dt.isoformat(sep=" ")).cast("timestamp")


@dataclass(frozen=True)
class EventQuery:
    """Aggregation request predicate (tenant mandatory, the rest optional).

    ``environment``: not given -> ``default_environment``; ``None`` -> no filter.
    Empty strings and empty lists count as absent.
    """
    tenant_id: str | None
    timeline_ids: tuple[str, ...] = field(default_factory=tuple)
    media_content_id: str | None = None
    start: Any = None  # inclusive
    end: Any = None    # exclusive
    platform: str | None = None
    environment: Any = USE_DEFAULT


def time_range(start=None, end=None, ts: str = "ts") -> Column | None:
    """Half-open event-time range ``start <= ts < end``; either end optional."""
    parts = []
    if start not in (None, ""):
        parts.append(F.col(ts) >= ts_lit(start))
    if end not in (None, ""):
        parts.append(F.col(ts) < ts_lit(end))
    return _and(parts)


def _and(parts: list[Column]) -> Column | None:
    out = None
    for p in parts:
        out = p if out is None else (out & p)
    return out


def event_predicate(q: EventQuery, default_environment: str = DEFAULT_ENVIRONMENT) -> Column:
    if not q.tenant_id:
        raise ValueError("tenantId is required for event queries")
    parts = [F.col("tenant_id") == F.lit(q.tenant_id)]
    env = default_environment if q.environment is USE_DEFAULT else q.environment
    if env is not None:
        parts.append(F.col("environment") == F.lit(env))
    if q.timeline_ids:
        parts.append(F.col("timeline_id").isin(list(q.timeline_ids)))
    if q.media_content_id:
        parts.append(F.col("media_content_id") == F.lit(q.media_content_id))
    rng = time_range(q.start, q.end)
    if rng is not None:
        parts.append(rng)
    if q.platform:
        parts.append(F.col("platform") == F.lit(q.platform))
    return _and(parts)


@dataclass(frozen=True)
class MetricQuery:
    """Stored-metric filter: tenant, match?, timelines IN?, intervalFrom in CLOSED [start, end]."""
    tenant_id: str | None
    match_id: str | None = None
    timeline_ids: tuple[str, ...] = field(default_factory=tuple)
    start: Any = None
    end: Any = None


def metric_predicate(q: MetricQuery, sort_field: str = "intervalFrom") -> Column:
    if not q.tenant_id:
        raise ValueError("tenantId is required for metric reads")
    parts = [F.col("tenantId") == F.lit(q.tenant_id)]
    if q.match_id:
        parts.append(F.col("matchId") == F.lit(q.match_id))
    if q.timeline_ids:
        parts.append(F.col("timelineId").isin(list(q.timeline_ids)))
    if q.start not in (None, ""):
        parts.append(F.col("intervalFrom") >= ts_lit(q.start))
    if q.end not in (None, ""):
        parts.append(F.col("intervalFrom") <= ts_lit(q.end))
    return _and(parts)


@dataclass(frozen=True)
class RealtimeQuery:
    """Realtime request: timelines, else [questionId], else none; match filter only
    without timelines; environment never filtered."""
    timeline_ids: tuple[str, ...] = field(default_factory=tuple)
    question_id: str | None = None
    match_id: str | None = None
    start: Any = None
    end: Any = None
    platform: str | None = None

    def effective_timelines(self) -> tuple[str, ...]:
        if self.timeline_ids:
            return tuple(self.timeline_ids)
        if self.question_id:
            return (self.question_id,)
        return ()

    def to_event_query(self, tenant_id: str | None) -> EventQuery:
        tls = self.effective_timelines()
        return EventQuery(
            tenant_id=tenant_id,
            timeline_ids=tls,
            media_content_id=None if tls else self.match_id,
            start=self.start, end=self.end, platform=self.platform,
            environment=None,
        )

    def context_timeline(self) -> str:
        return (self.timeline_ids[0] if self.timeline_ids else None) or self.question_id or ""


def describe_request(q: RealtimeQuery, tenant_id: str | None = None) -> str:
    """The filter of a request in words, as its debug views show it (the time range is half-open)."""
    def quoted(v) -> str:
        return "'" + str(v).replace("'", "\\'") + "'"
    eq = q.to_event_query(tenant_id or "*")
    parts = [f"tenant_id = {quoted(tenant_id)}" if tenant_id else "tenant_id IS NOT NULL"]
    if eq.timeline_ids:
        parts.append(f"timeline_id IN ({', '.join(map(quoted, eq.timeline_ids))})")
    if eq.media_content_id:
        parts.append(f"media_content_id = {quoted(eq.media_content_id)}")
    parts += [f"ts {op} {quoted(to_utc(v).strftime('%Y-%m-%dT%H:%M:%S.%fZ'))}" for op, v in ((">=", eq.start), ("<", eq.end)) if v not in (None, "")]
    if eq.platform:
        parts.append(f"platform = {quoted(eq.platform)}")
    return " AND ".join(parts)


def realtime_predicate(q: RealtimeQuery, tenant_id: str | None = None) -> Column:
    """P5 predicate.  ``tenant_id=None`` evaluates the request for every tenant at
    once (tenant becomes a group key instead of a filter)."""
    eq = q.to_event_query(tenant_id or "*")
    parts = []
    if tenant_id:
        parts.append(F.col("tenant_id") == F.lit(tenant_id))
    else:
        parts.append(F.col("tenant_id").isNotNull())
    if eq.timeline_ids:
        parts.append(F.col("timeline_id").isin(list(eq.timeline_ids)))
    if eq.media_content_id:
        parts.append(F.col("media_content_id") == F.lit(eq.media_content_id))
    rng = time_range(eq.start, eq.end)
    if rng is not None:
        parts.append(rng)
    if eq.platform:
        parts.append(F.col("platform") == F.lit(eq.platform))
    return _and(parts)

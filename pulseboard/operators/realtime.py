"""On-demand ("realtime") views computed straight from the events.

A realtime request has its own predicate profile (P5: environment never
filtered, the match filter dropped when timelines are given) and context
defaults (P6: interval from epoch 0 to ``now``).  ``now`` is always an argument.

``tenant_id=None`` evaluates the same request for every tenant in one plan:
the tenant becomes a group key instead of a filter, so one job answers the
request for all tenants (the distributed form of one call per tenant).
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseboard.functions.numeric import calc_rate
from pulseboard.operators import metrics as M
from pulseboard.operators.context import literal_context
from pulseboard.operators.predicates import RealtimeQuery, describe_request, realtime_predicate, ts_lit

EPOCH = datetime(1970, 1, 1)


def _dec_sum(c: str):
    return F.sum(F.col(c).cast("decimal(38,2)")).cast("double")


class Realtime:
    """One realtime request over a flat event frame."""

    def __init__(self, events: DataFrame, q: RealtimeQuery, tenant_id: str | None = None,
                 now: datetime | str | None = None):
        if q.end in (None, "") and now is None:
            raise ValueError("realtime requests without 'to' need an explicit now")
        self.q, self.tenant_id = q, tenant_id
        self.interval_from = q.start if q.start not in (None, "") else EPOCH
        self.interval_to = q.end if q.end not in (None, "") else now
        self.base = literal_context(events.where(realtime_predicate(q, tenant_id)),
                                    match_id=q.match_id or "", timeline_id=q.context_timeline(),
                                    interval_from=self.interval_from, interval_to=self.interval_to)
        self.keys = [] if tenant_id else ["tenantId"]
        #: The filter in words, which the debug views return.
        self.predicate = describe_request(q, tenant_id)

    # A13
    def funnel(self) -> DataFrame:
        """Platform rows summed over platforms, then four rates (round(n/d*10000)/100).

        With a fixed tenant the global aggregate always yields one row (zeros
        when nothing matched).  Sums of the 2-decimal platform values are exact.
        """
        plat = M.platform_metrics(self.base)
        grouped = plat.groupBy(*self.keys) if self.keys else plat.groupBy()
        sums = grouped.agg(
            F.coalesce(_dec_sum("sent"), F.lit(0.0)).alias("sent"),
            F.coalesce(F.sum("received"), F.lit(0)).cast("long").alias("received"),
            F.coalesce(F.sum("rendered"), F.lit(0)).cast("long").alias("rendered"),
            F.coalesce(F.sum("failed"), F.lit(0)).cast("long").alias("failed"),
        )
        return sums.select(
            *self.keys, "sent", "received", "rendered", "failed",
            calc_rate("received", "sent").alias("receiveRate"),
            calc_rate("rendered", "received").alias("renderRate"),
            calc_rate("failed", "received").alias("failureRate"),
            calc_rate("rendered", "sent").alias("netSuccessRate"),
        )

    # A14
    def heatmap(self) -> DataFrame:
        return M.platform_metrics(self.base).select(*self.keys, "platform", "sent", "received",
                                                    "rendered", "failed")

    # P11 projections
    def failures(self) -> DataFrame:
        return M.failure_analysis(self.base).select(*self.keys, "failureReason", "failureStep",
                                                    "count", "percentOfFailed")

    def device(self, dimension: str | None = None) -> DataFrame:
        """The output ``dimension`` column carries the bucket key."""
        return M.device_breakdown(self.base, [dimension or "browser"]).select(
            *self.keys, F.col("bucketKey").alias("dimension"), "received", "rendered", "failed",
            "renderRate", "avgRenderMs")

    def transport(self) -> DataFrame:
        return M.transport_comparison(self.base).select(*self.keys, "transportMode", "count", "renderRate", "avgRenderMs", "p95RenderMs")

    def sdk(self) -> DataFrame:
        return M.sdk_versions(self.base).select(*self.keys, "sdkVersion", "count", "renderRate",
                                                "avgRenderMs")

    # A12
    def timeseries(self, metric: str | None = None, interval: str | None = None) -> DataFrame:
        """Any fixed interval (default 1m), one metric (default sent), ascending by bucket."""
        ts = M.timeseries(self.base, [metric or "sent"], interval or "1m")
        return ts.select(*self.keys, "time", "value").orderBy(*self.keys, "time")  # L4: ascending buckets

    # latency view: one row (per tenant), zeros when empty
    def latency(self, approx_accuracy: int | None = None) -> DataFrame:
        """Exact percentiles (``approx_accuracy`` uses the sketch)."""
        raw = M.latency_aggregates(self.base, group_cols=self.keys, approx_accuracy=approx_accuracy)
        tenant = F.col("tenantId") if self.keys else F.lit(self.tenant_id).alias("tenantId")
        return raw.select(F.lit(self.q.context_timeline()).alias("timelineId"),
                          F.lit(self.q.match_id or "").alias("matchId"), tenant,
                          ts_lit(self.interval_from).alias("intervalFrom"),
                          ts_lit(self.interval_to).alias("intervalTo"),
                          *M.latency_derived_columns())

    # A17
    def funnel_debug(self) -> DataFrame:
        """Raw bucket aggregates next to the derived platform rows (one projection, no join)."""
        raw = M.platform_raw(self.base)
        return raw.select(*self.keys, "platform", "doc_count",
                          F.col("sent_raw"), F.col("received_raw"), F.col("rendered_raw"),
                          F.col("failed_raw"), F.col("avg_render_raw"),
                          *[c for c in M.platform_derived_columns()], F.lit(self.predicate).alias("predicate"))

    def latency_debug(self) -> DataFrame:
        raw = M.latency_aggregates(self.base, group_cols=self.keys)
        raw_cols = [c for c in raw.columns if c.endswith("_raw")]
        return raw.select(*self.keys, *raw_cols, *M.latency_derived_columns(), F.lit(self.predicate).alias("predicate"))

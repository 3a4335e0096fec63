"""Match-level funnel with per-question rows (A16; documented in the reference, never coded).

Per (tenant, match): stage totals over all its timelines and rates; per
question (= timeline) the counts and rates of every timeline (``top_n``: the
largest by row count).  Rates follow the implemented platform formulas (receive =
received/sent, render = rendered/received, failure = failed/received, net =
rendered/sent), since the code is the trusted side where docs disagree.

Two-level aggregation: one partial+final aggregate per (tenant, match,
timeline), then the match totals over those small rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseboard.functions.numeric import exact_sum, r2_sql, rate, stage_is
from pulseboard.operators.topk import top_n_per_group
from pulseboard.schema import STAGE_FAILED, STAGE_RECEIVED, STAGE_RENDERED, STAGE_SENT

def per_question(events: DataFrame) -> DataFrame:
    """Raw per-timeline stage totals of flat events (tenant, match, timeline)."""
    return (events.where(F.col("media_content_id").isNotNull() & F.col("timeline_id").isNotNull())
            .groupBy(F.col("tenant_id").alias("tenantId"), F.col("media_content_id").alias("matchId"),
                     F.col("timeline_id").alias("timelineId"))
            .agg(exact_sum(F.when(stage_is(STAGE_SENT), F.col("room_size"))).alias("_sent"),
                 F.count(F.when(stage_is(STAGE_RECEIVED), 1)).alias("received"),
                 F.count(F.when(stage_is(STAGE_RENDERED), 1)).alias("rendered"),
                 F.count(F.when(stage_is(STAGE_FAILED), 1)).alias("failed"),
                 F.count(F.lit(1)).alias("doc_count")))


def match_funnel_questions(events: DataFrame, top_n: int | None = None) -> DataFrame:
    q = top_n_per_group(per_question(events), ["tenantId", "matchId"], "doc_count", "timelineId", top_n)
    sent = r2_sql("_sent")
    return q.select("tenantId", "matchId", "timelineId", F.expr(sent).alias("sent"), "received", "rendered", "failed",
                    rate("received", sent).alias("receiveRate"), rate("rendered", "received").alias("renderRate"))


def match_funnel(events: DataFrame) -> DataFrame:
    totals = per_question(events).groupBy("tenantId", "matchId").agg(
        exact_sum("_sent").alias("_sent"),
        F.sum("received").alias("received"), F.sum("rendered").alias("rendered"),
        F.sum("failed").alias("failed"),
        F.count(F.lit(1)).alias("questionCount"))
    sent = r2_sql("_sent")
    return totals.select("tenantId", "matchId", F.expr(sent).alias("sent"), "received", "rendered", "failed",
                         rate("received", sent).alias("receiveRate"),
                         rate("rendered", "received").alias("renderRate"),
                         rate("failed", "received").alias("failureRate"),
                         rate("rendered", sent).alias("netSuccessRate"),
                         "questionCount")

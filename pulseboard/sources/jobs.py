"""Job-side inputs: scheduler targets, tenants, backfill requests and job messages.

In production these are small tables (targets, tenants) and a message stream.
For the driver's test data they are *derived from the event fixture* by
fixed rules (FIXTURES.md §2), so their size follows the data:

* targets: one per (tenant, match) with the sorted set of its timelines;
  disabled when the match number mod 5 is 4.
* tenants: every tenant seen; ``tenant-2`` is INACTIVE.
* backfill requests: three per target (two overlapping January ranges and an
  empty March day); the caller of match-5 is another tenant (P12).
* job messages: the scheduled jobs as JSON plus seven defect variants per target.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseboard.plans.jobs import encode_jobs, expand_scheduled

# Fixture rules for the derived job inputs.
INACTIVE_TENANT = "tenant-2"
DISABLED_MATCH_MOD5 = 4
BACKFILL_WINDOWS = [
    ("2024-01-06T00:00:00.000Z", "2024-01-13T00:00:00.000Z"),
    ("2024-01-10T00:00:00.000Z", "2024-01-20T00:00:00.000Z"),
    ("2024-03-01T00:00:00.000Z", "2024-03-02T00:00:00.000Z"),
]
OTHER_CALLER_MATCH = "match-5"
OTHER_CALLER = "tenant-0"


def _match_no():
    return F.regexp_extract(F.col("matchId"), r"(\d+)$", 1).cast("int")


def fixture_targets(events: DataFrame) -> DataFrame:
    t = (events.where(F.col("tenant_id").isNotNull() & F.col("media_content_id").isNotNull()
                      & F.col("timeline_id").isNotNull())
         .groupBy(F.col("tenant_id").alias("tenantId"), F.col("media_content_id").alias("matchId"))
         .agg(F.array_sort(F.collect_set("timeline_id")).alias("timelineIds")))
    return t.withColumn("enabled", (_match_no() % 5) != DISABLED_MATCH_MOD5)


def fixture_tenants(events: DataFrame) -> DataFrame:
    names = events.where(F.col("tenant_id").isNotNull()).select(F.col("tenant_id").alias("name")).distinct()
    return names.withColumn("status", F.when(F.col("name") == INACTIVE_TENANT, "INACTIVE").otherwise("ACTIVE"))


def fixture_backfill_requests(targets: DataFrame) -> DataFrame:
    windows = F.array(*[F.struct(F.lit(a).alias("intervalFrom"), F.lit(b).alias("intervalTo"))
                        for a, b in BACKFILL_WINDOWS])
    r = targets.select("tenantId", "matchId", "timelineIds", F.inline(windows))
    return r.withColumns({
        "timeRangeMinutes": F.lit(None).cast("double"),
        "callerTenant": F.when(F.col("matchId") == OTHER_CALLER_MATCH, F.lit(OTHER_CALLER))
                         .otherwise(F.col("tenantId")),
        "correlationKey": F.md5(F.concat_ws("|", "tenantId", "matchId", "intervalFrom", "intervalTo")),
    })


def _q(c) -> F.Column:
    return F.concat(F.lit('"'), c, F.lit('"'))


def defect_messages(targets: DataFrame) -> DataFrame:
    """Seven hand-shaped messages per target, each breaking (or stretching) one rule."""
    t, m = F.col("tenantId"), F.col("matchId")
    tl = F.element_at("timelineIds", 1)
    head = F.concat(F.lit('{"tenantId":'), _q(t), F.lit(',"matchId":'), _q(m), F.lit(',"timelineId":'), _q(tl))
    variants = [
        F.concat(head, F.lit(',"timeRangeMinutes":0}')),                                   # range 0
        F.concat(F.lit('{"tenantId":7,"matchId":'), _q(m), F.lit(',"timelineId":'), _q(tl),
                 F.lit(',"timeRangeMinutes":60}')),                                          # tenant number
        F.concat(head, F.lit(',"timeRangeMinutes":60')),                                     # truncated JSON
        F.concat(head, F.lit(',"timeRangeMinutes":5,"intervalFrom":"not-a-date","intervalTo":"2024-01-02T00:00:00.000Z"}')),
        F.concat(head, F.lit(',"timeRangeMinutes":5,"intervalFrom":"2024-01-05T00:00:00.000Z","intervalTo":"2024-01-04T00:00:00.000Z"}')),
        F.concat(head, F.lit(',"timeRangeMinutes":5,"intervalFrom":"2024-01-05T00:00:00.000Z"}')),
        F.concat(head, F.lit(',"timeRangeMinutes":7.5,"retryCount":2,"origin":"backfill"}')),  # valid, fractional
    ]
    return targets.select(F.explode(F.array(*variants)).alias("value"))


def fixture_job_messages(events: DataFrame, now: str) -> DataFrame:
    targets = fixture_targets(events)
    scheduled = encode_jobs(expand_scheduled(targets, fixture_tenants(events), now)).select("value")
    return scheduled.unionByName(defect_messages(targets))

"""Tracking-event sources.

Real events are nested documents (``labels.*`` strings, ``numeric_labels.*``
numbers, ``@timestamp``) spread over many files of one logical table; they
are read with an explicit schema, never inferred.  Every operator works on
the *flat* form produced by :func:`flatten_events`.

The driver's test data has no such table, so :func:`fixture_events` maps its
``events`` table onto tracking events with integer-only rules (documented in
FIXTURES.md §2) so that Spark and the DuckDB oracle agree bit for bit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseboard.schema import EVENT_LABELS, EVENT_NUMERICS, TRACKING_EVENT_SCHEMA

FLAT_COLUMNS = ["event_id", "ts", *EVENT_LABELS, *EVENT_NUMERICS]
FLAT_SCHEMA = ", ".join(["event_id bigint", "ts timestamp", *(f"{c} string" for c in EVENT_LABELS),
                         *(f"{c} double" for c in EVENT_NUMERICS)])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_tracking_events(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Scan a (glob of) nested tracking-event files with the fixed schema."""
    reader = spark.read.schema(TRACKING_EVENT_SCHEMA)
    if fmt == "json":
        reader = reader.option("mode", "PERMISSIVE")
    return reader.format(fmt).load(path)


def flatten_events(nested: DataFrame) -> DataFrame:
    """Dotted access ``labels.x`` / ``numeric_labels.y`` -> flat columns.

    Column pruning still reaches the scan: only the nested leaves that later
    operators reference are read.
    """
    cols: list[Column] = [F.lit(None).cast("long").alias("event_id"),
                          F.col("`@timestamp`").alias("ts")]
    cols += [F.col(f"labels.{n}").alias(n) for n in EVENT_LABELS]
    cols += [F.col(f"numeric_labels.{n}").cast("double").alias(n) for n in EVENT_NUMERICS]
    return nested.select(*cols)


# Test-data mapping of the driver's events table (FIXTURES.md §2).
STAGE_OF_EVENT_TYPE = {
    "signup": "sent",
    "view": "received",
    "click": "rendered",
    "error": "render-failed",
    "purchase": "ack",
}
PLATFORM_BY_K5 = {0: "web", 1: "ios", 2: "android", 3: "smarttv", 4: None}
BROWSER_BY_ID4 = {0: "Chrome", 1: "Firefox", 2: "Safari", 3: None}
OS_BY_ID5 = {0: "Windows", 1: "macOS", 2: "Linux", 3: "Android", 4: None}
DEVICE_BY_ID3 = {0: "Desktop", 1: "Mobile", 2: "Tablet"}
REASON_BY_ID3 = {0: "timeout", 1: "network", 2: "validation"}
STEP_BY_ID4 = {0: "load-overlay", 1: "render-overlay", 2: "ack-event", 3: "schema-check"}


def fixture_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat tracking events derived from ``{sf_dir}/events.parquet``."""
    return map_fixture_events(read_table(spark, sf_dir, "events"))


def fixture_event_stream(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The same mapping over a file stream of the driver's ``events`` table."""
    path = f"{sf_dir.rstrip('/')}/events.parquet"
    schema = spark.read.parquet(path).schema
    # a file stream watches a directory: keep only the events file of the folder
    reader = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return map_fixture_events(reader.parquet(sf_dir))


def _case_sql(key: str, mapping: dict) -> str:
    arms = " ".join(f"WHEN {k!r} THEN {('NULL' if v is None else repr(v))}" for k, v in mapping.items())
    return f"CASE {key} {arms} END"


def fixture_projection() -> list[str]:
    """The mapping as SQL expressions (one ``selectExpr``: a single call into the JVM)."""
    k = "CAST(get_json_object(props, '$.k') AS INT)"
    return [
        "event_id",
        "CAST(ts AS TIMESTAMP) AS ts",
        "concat('tl-', CAST(user_id % 30 AS STRING)) AS timeline_id",
        "concat('tenant-', CAST(user_id % 3 AS STRING)) AS tenant_id",
        "concat('match-', CAST(user_id % 6 AS STRING)) AS media_content_id",
        "CASE WHEN event_id % 10 = 0 THEN 'production' ELSE 'development' END AS environment",
        f"{_case_sql('event_type', STAGE_OF_EVENT_TYPE)} AS stage",
        f"{_case_sql(f'{k} % 5', PLATFORM_BY_K5)} AS platform",
        f"{_case_sql('event_id % 4', BROWSER_BY_ID4)} AS browser",
        f"{_case_sql('event_id % 5', OS_BY_ID5)} AS client_os",
        f"{_case_sql('event_id % 3', DEVICE_BY_ID3)} AS device_class",
        "CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 3 = 0 THEN 'longPolling' "
        "ELSE 'wsInteractive' END AS transport_mode",
        "CASE WHEN event_id % 13 = 0 THEN NULL ELSE concat('v2.', CAST(event_id % 7 AS STRING), '.0') END "
        "AS sdk_version",
        f"CASE WHEN event_type = 'error' AND event_id % 9 <> 0 THEN {_case_sql('event_id % 3', REASON_BY_ID3)} "
        "END AS failure_reason",
        f"CASE WHEN event_type = 'error' AND event_id % 8 <> 0 THEN {_case_sql('event_id % 4', STEP_BY_ID4)} "
        "END AS failure_step",
        "CASE WHEN event_type = 'signup' THEN CAST(10 + event_id % 90 AS DOUBLE) END AS room_size",
        "CASE WHEN event_type IN ('click', 'error') THEN value END AS render_duration_ms",
        "CASE WHEN event_type = 'view' THEN value END AS receive_latency_ms",
        "CASE WHEN event_type = 'purchase' THEN value END AS ack_latency_ms",
    ]


def map_fixture_events(ev: DataFrame) -> DataFrame:
    """Pure projection (works on batch and streaming frames)."""
    return ev.selectExpr(*fixture_projection())

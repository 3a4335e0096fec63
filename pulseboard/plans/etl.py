"""All metrics in one run (A18) and the ETL write path.

The reference runs seven metric "pipelines" per job concurrently; a failure
in one does not stop the others and a combined error follows.  Here one scan
of the events gives a pre-aggregate over *all* jobs; the seven tables derive from it and
are merged concurrently from a thread pool (Spark schedules them side by side), and the
same isolation and combined error apply.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from pulseboard.operators import metrics as M
from pulseboard.operators import one_scan as OS
from pulseboard.plans import jobs as JB
from pulseboard.plans import store as ST
from pulseboard.session import cut_lineage

MetricFn = Callable[[DataFrame], DataFrame]

class MetricRunError(RuntimeError):
    def __init__(self, failures: dict[str, str]):
        self.failures = failures
        super().__init__("failed metrics: " + ", ".join(sorted(failures)))


def metric_frame(name: str, fn: MetricFn, base: DataFrame, jobs: DataFrame | None = None, pre: DataFrame | None = None) -> DataFrame:
    """Per-job rows of one metric (with ``jobs``, latency gets zero rows for empty jobs).

    A metric of the library is taken from the pre-aggregate ``pre`` where there is one, another function gets the events."""
    shared = pre is not None and fn is M.METRIC_FUNCTIONS.get(name)
    if name == "latency" and jobs is not None:
        flat = OS.latency_flat(pre) if shared else M.latency_percentiles(base)
        return M.latency_nested(JB.zero_fill_latency(jobs, flat))
    return OS.TABLES[name](pre) if shared else fn(base)


def metric_frames(base: DataFrame, registry: dict[str, MetricFn] | None = None,
                  jobs: DataFrame | None = None) -> dict[str, DataFrame]:
    registry = M.METRIC_FUNCTIONS if registry is None else registry
    return {name: metric_frame(name, fn, base, jobs) for name, fn in registry.items()}


def run_all(spark: SparkSession, base: DataFrame, store_root: str, mode: str = "idempotent",
            registry: dict[str, MetricFn] | None = None, jobs: DataFrame | None = None,
            now: datetime | str | None = None, parallelism: int = 7) -> dict[str, DataFrame]:
    """Compute every metric and merge it into ``{store_root}/{metric}``.

    The events are scanned once: the long pre-aggregate of all metrics is checkpointed, and the tables of
    the library's own metrics derive from it (operators.one_scan).  Further functions in ``registry`` scan the events themselves.
    """
    registry = dict(M.METRIC_FUNCTIONS) if registry is None else registry
    own = [n for n, fn in registry.items() if fn is M.METRIC_FUNCTIONS.get(n)]
    pre = cut_lineage(OS.pre_aggregate(base)) if own else None
    failures: dict[str, str] = {}
    results: dict[str, DataFrame] = {}

    def one(name: str):
        try:
            rows = metric_frame(name, registry[name], base, jobs, pre)
            results[name] = ST.upsert_table(spark, f"{store_root.rstrip('/')}/{name}", rows, name,
                                            mode=mode, now=now, jobs=jobs)
        except Exception as e:  # noqa: BLE001 - isolate one metric's failure from the others
            failures[name] = f"{type(e).__name__}: {e}"

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        list(pool.map(one, registry))
    if failures:
        raise MetricRunError(failures)
    return results


def backfill(spark: SparkSession, events: DataFrame, requests: DataFrame, store_root: str,
             *, environment: str | None, now: datetime | str, mode: str = "idempotent",
             caller_tenant_col: str | None = None, correlation_id=None,
             registry: dict[str, MetricFn] | None = None) -> dict[str, DataFrame]:
    """K3: backfill requests -> jobs -> range join with the events -> all metrics -> store.

    ``environment`` is the deployment's own (null: events of all).  Requests
    without an explicit interval are aligned at ``now`` (T1), which is also the audit time.
    """
    jobs = JB.expand_backfill(requests, caller_tenant_col=caller_tenant_col, correlation_id=correlation_id)
    valid = JB.valid_jobs(JB.validate_jobs(JB.encode_jobs(jobs)), now)
    base = JB.jobs_join_events(valid, events, environment=environment)
    return run_all(spark, base, store_root, mode=mode, registry=registry, jobs=valid, now=now)

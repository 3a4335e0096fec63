"""Metric store: match rollup, accumulating / idempotent upsert, reads, retention
(A15, S3, S4, S6, J3, W2, P3, P4, L3, T6, ST3 building blocks).

Tables are Parquet directories partitioned by ``tenantId`` and ``intervalDate``
(the UTC day of ``intervalFrom``, of ``time`` for the timeseries table): a
tenant's rows live apart (tenant isolation) and an upsert rewrites only the
partitions it touches (dynamic partition overwrite).

Upsert semantics of the reference: for a unique key, accumulated fields are
*added* (``$inc``) and every other field takes the value of the last write
(``$set``).  The write order of concurrent per-timeline jobs is undefined
there; here it is fixed: ascending ``(intervalFrom, timelineId, intervalTo)``, greatest wins.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulseboard.operators.predicates import MetricQuery, metric_predicate, to_utc, ts_lit
from pulseboard.schema import METRIC_META
from pulseboard.session import cut_lineage

ORDER = ("intervalFrom", "timelineId", "intervalTo")
TIMESERIES_RETENTION_DAYS = 90  # Fixed value: TTL of timeseries rows.
JOB_KEY = ("tenantId", "matchId", "timelineId", "intervalFrom", "intervalTo")
TOUCHED_BROADCAST_MAX = 200_000  # (tenant, day) pairs of one upsert that may be broadcast


def _sum_exact(c: str, dtype: T.DataType):
    if isinstance(dtype, T.DoubleType | T.FloatType):
        # accumulated doubles are 2-decimal normalised values: a DECIMAL sum is exact
        return F.sum(F.col(c).cast("decimal(38,2)")).cast("double")
    return F.sum(c)


def match_rollup(rows: DataFrame, metric_type: str, order: tuple[str, ...] = ORDER) -> DataFrame:
    """Collapse per-job rows onto the table's unique key, the way a sequence
    of upserts would: Σ accumulated fields, last writer for every other field.

    One ``groupBy`` with ``max_by(struct(...), struct(order))`` - partial
    aggregation, no window, no self-join.
    """
    meta = METRIC_META[metric_type]
    key = list(meta.unique)
    types = dict((f.name, f.dataType) for f in rows.schema.fields)
    inc = [c for c in meta.accumulate if c in rows.columns]
    audit = [c for c in ("createdAt", "updatedAt") if c in rows.columns]
    rest = [c for c in rows.columns if c not in key and c not in inc and c not in audit]
    aggs = [_sum_exact(c, types[c]).alias(c) for c in inc]
    # audit times of a match row: first creation and last update of its contributions
    aggs += [(F.min(c) if c == "createdAt" else F.max(c)).alias(c) for c in audit]
    if rest:
        aggs.append(F.max_by(F.struct(*rest), F.struct(*[F.col(o) for o in order])).alias("_last"))
    out = rows.groupBy(*key).agg(*aggs)
    cols = ([F.col(c) for c in key] + [F.col(c) for c in inc] + [F.col(c) for c in audit]
            + [F.col(f"_last.{c}").alias(c) for c in rest])
    return out.select(*cols).select(*rows.columns)


def upsert(old: DataFrame | None, new: DataFrame, metric_type: str,
           now: datetime | str | None = None) -> DataFrame:
    """S4 / J3 accumulate mode: ``old ⟗ rollup(new)`` on the unique key.

    Accumulated fields add up (a rerun of the same job counts twice - the
    reference's behaviour); other fields come from the new row when there is
    one.  ``createdAt`` keeps the first write, ``updatedAt`` the last (only when
    ``now`` is given).
    """
    meta = METRIC_META[metric_type]
    key = list(meta.unique)
    n = match_rollup(new, metric_type)
    if now is not None:
        n = n.withColumns({"createdAt": ts_lit(now), "updatedAt": ts_lit(now)})
    if old is None:
        return n
    cols = [c for c in n.columns]
    o = old.select(*[c for c in cols if c in old.columns]).alias("o")
    n = n.withColumn("_new", F.lit(True)).alias("n")
    j = o.join(n, key, "full_outer")
    is_new = F.col("n._new").isNotNull()
    out = []
    for c in cols:
        if c in key:
            out.append(F.col(c))
        elif c in meta.accumulate:
            out.append((F.coalesce(F.col(f"o.{c}"), F.lit(0)) + F.coalesce(F.col(f"n.{c}"), F.lit(0))).alias(c))
        elif c == "createdAt":
            out.append(F.coalesce(F.col("o.createdAt"), F.col("n.createdAt")).alias(c))
        else:
            out.append(F.when(is_new, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c))
    return j.select(*out)


def contribution_key(metric_type: str) -> list[str]:
    """Key of one job's contribution: the unique key plus the job identity.

    Two jobs of one start and different ends are two jobs: neither replaces the other, and both count."""
    key = list(METRIC_META[metric_type].unique)
    return key + [c for c in JOB_KEY if c not in key]


def replace_contributions(old_contrib: DataFrame | None, new: DataFrame, metric_type: str,
                          by: str = "job", jobs: DataFrame | None = None) -> DataFrame:
    """Idempotent mode: new rows replace old ones (rerun-safe).

    ``by='job'``: a batch run recomputes whole jobs, so all old rows of those jobs
    go (a bucket that disappeared disappears).  ``by='row'``: a streaming update
    carries only the changed buckets, so only rows with the same contribution
    key are replaced.  With ``jobs``, the rows of every listed job go, also of one that has no new rows.
    """
    if old_contrib is None:
        return new
    keys = list(JOB_KEY) if by == "job" else contribution_key(metric_type)
    gone = new.select(*keys)
    if jobs is not None and by == "job":
        if lacking := [k for k in keys if k not in jobs.columns]:
            raise ValueError(f"the job list has no column {', '.join(lacking)}; a job is named by {', '.join(keys)}")
        gone = gone.unionByName(jobs.select(*keys))
    gone = gone.distinct()
    kept = old_contrib.join(gone, keys, "left_anti")
    return kept.select(*new.columns).unionByName(new)


def idempotent_upsert(old_contrib: DataFrame | None, new: DataFrame, metric_type: str) -> DataFrame:
    """Match-level rows derived from the contribution table: equal for any number of reruns."""
    return match_rollup(replace_contributions(old_contrib, new, metric_type), metric_type)


# ------------------------------------------------------------------ physical table I/O
def partition_day(metric_type: str):
    col = "time" if metric_type == "timeseries" else "intervalFrom"
    return F.to_date(F.col(col)).alias("intervalDate")


def job_days(jobs: DataFrame, metric_type: str) -> DataFrame:
    """(tenantId, intervalDate) partitions that rows of the jobs may lie in."""
    first = F.to_date("intervalFrom")
    if metric_type != "timeseries":
        return jobs.select("tenantId", first.alias("intervalDate")).distinct()
    # partitioned by the day of the bucket, which starts at or before its first event
    last = F.greatest(first, F.to_date(F.col("intervalTo") - F.expr("INTERVAL 1 MICROSECOND")))
    return jobs.select("tenantId", F.explode(F.sequence(F.date_sub(first, 1), last)).alias("intervalDate")).distinct()


def drop_emptied(spark: SparkSession, path: str, touched: DataFrame, rows: DataFrame, metric_type: str) -> None:
    """Remove the files of ``touched`` partitions that hold none of ``rows``: a dynamic overwrite leaves them as they were."""
    if not _exists(spark, path):
        return
    left = rows.select("tenantId", partition_day(metric_type)).distinct()
    emptied = touched.join(left, ["tenantId", "intervalDate"], "left_anti")
    stored = spark.read.schema("tenantId string, intervalDate date").parquet(path)
    files = stored.withColumn("_file", F.col("_metadata.file_path")).join(emptied, ["tenantId", "intervalDate"], "left_semi")
    jvm = spark._jvm
    for r in files.select("_file").distinct().toLocalIterator():  # file names of emptied partitions
        hpath = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(r["_file"]))
        hpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hpath, False)


def write_table(df: DataFrame, path: str, metric_type: str) -> None:
    """Dynamic partition overwrite: only the (tenant, day) partitions present in ``df``."""
    (df.withColumn("intervalDate", partition_day(metric_type))
       .hint("rebalance", "tenantId", "intervalDate")  # few files a day, and several tasks for a hot one
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy("tenantId", "intervalDate").parquet(path))


def read_table(spark: SparkSession, path: str, with_day: bool = False) -> DataFrame | None:
    if not _exists(spark, path):
        return None
    stored = spark.read.parquet(path).schema
    # folder names are text: tenant "0012" is neither 12 nor the tenant "12"
    names = {"tenantId": T.StringType(), "intervalDate": T.DateType()}
    schema = T.StructType([T.StructField(f.name, names.get(f.name, f.dataType)) for f in stored.fields])
    table = spark.read.schema(schema).parquet(path)
    return table if with_day else table.drop("intervalDate")


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(hpath)


def read_partitions(spark: SparkSession, path: str, touched: DataFrame,
                    like: DataFrame | None = None) -> DataFrame | None:
    """Rows of the (tenantId, intervalDate) partitions listed in ``touched`` only.

    The semi join on partition columns lets dynamic partition pruning skip every
    other partition of the scan.
    """
    if not _exists(spark, path):
        return None
    # the schema is given (not inferred): a table written from zero rows has no files
    schema = T.StructType([*like.schema.fields, T.StructField("intervalDate", T.DateType())]) \
        if like is not None else None
    reader = spark.read.schema(schema) if schema is not None else spark.read
    # the touched (tenant, day) list is counted with a bound; broadcast below it, so
    # dynamic partition pruning reuses the broadcast and lists only those folders
    n = touched.limit(TOUCHED_BROADCAST_MAX + 1).count()
    side = F.broadcast(touched) if n <= TOUCHED_BROADCAST_MAX else touched
    return (reader.parquet(path).join(side, ["tenantId", "intervalDate"], "left_semi")
            .drop("intervalDate"))


def require_keys(rows: DataFrame, metric_type: str) -> DataFrame:
    """A row with a null unique field fails the write (as the reference's upsert does).

    Lazy: ``raise_error`` fires inside the write's tasks, no extra pass over the data.
    """
    key = METRIC_META[metric_type].unique
    missing = None
    for k in key:
        cond = F.col(k).isNull()
        missing = cond if missing is None else (missing | cond)
    msg = F.concat(F.lit(f"Missing unique field required for {metric_type} upsert: "),
                   F.concat_ws(",", *[F.when(F.col(k).isNull(), F.lit(k)) for k in key]))
    # the filter keeps every row; evaluating it raises on the first row without a key
    return rows.where(F.coalesce(F.when(missing, F.raise_error(msg)).cast("boolean"), F.lit(True)))


def upsert_table(spark: SparkSession, path: str, new: DataFrame, metric_type: str,
                 mode: str = "idempotent", now: datetime | str | None = None,
                 replace_by: str = "job", jobs: DataFrame | None = None,
                 truncate: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Merge ``new`` per-job rows into the table at ``path``; rewrite only touched partitions.

    ``mode='idempotent'`` keeps a contribution table next to it (one row per job
    and key; a rerun replaces its job's rows) and derives the match table from
    it; ``mode='accumulate'`` reproduces the reference's blind ``$inc``.  Every
    key lies inside one (tenant, day) partition, so the partition-local merge is
    complete.  ``jobs`` lists the jobs of the run: one without new rows, or with fewer than before, loses its
    old ones on every day it spans, and a partition left without rows is removed.  ``truncate`` (idempotent mode) is applied to the contribution rows
    before the rollup: a stream keeps every bucket in the contributions and
    applies the per-job top-N here, once all buckets of the job are known.

    Materialisation: the new metric rows are checkpointed once (reliable
    checkpoint in the shared checkpoint dir) - they are small next to the
    events, and every later step (touched partitions, replace, union) reads
    them instead of re-running the aggregation.  A merge that reads the same
    partitions it overwrites is checkpointed before the write as well; the match
    table is rolled up from the committed contribution partitions.
    """
    new = require_keys(new, metric_type)
    if mode == "idempotent" and now is not None:
        new = new.withColumns({"createdAt": ts_lit(now), "updatedAt": ts_lit(now)})
    new = cut_lineage(new)
    touched = new.select("tenantId", partition_day(metric_type)).distinct()
    if mode == "idempotent":
        cpath = path.rstrip("/") + "_contrib"
        if jobs is not None and replace_by == "job":
            touched = cut_lineage(touched.unionByName(job_days(jobs, metric_type)).distinct())
        old_c = read_partitions(spark, cpath, touched, new)
        if old_c is not None and now is not None:
            # a contribution written again keeps the time it was first created
            ckey = contribution_key(metric_type)
            first = old_c.select(*ckey, F.col("createdAt").alias("_first"))
            new = (new.join(first, ckey, "left")
                   .withColumn("createdAt", F.coalesce(F.col("_first"), F.col("createdAt")))
                   .drop("_first").select(*new.columns))
        contrib = replace_contributions(old_c, new, metric_type, by=replace_by, jobs=jobs)
        if old_c is not None:
            contrib = cut_lineage(contrib)
        write_table(contrib, cpath, metric_type)
        if old_c is not None and jobs is not None:
            drop_emptied(spark, cpath, touched, contrib, metric_type)
        # a first write is the whole table: its rows are at hand
        contrib_rows = contrib if old_c is None else read_partitions(spark, cpath, touched, new)
        if truncate is not None:
            contrib_rows = truncate(contrib_rows)
        merged = match_rollup(contrib_rows, metric_type)
    elif mode == "accumulate":
        old = read_partitions(spark, path, touched, _stored_like(new, metric_type, now))
        merged = upsert(old, new, metric_type, now)
        if old is not None:
            merged = cut_lineage(merged)
    else:
        raise ValueError(f"unknown upsert mode {mode!r}")
    write_table(merged, path, metric_type)
    if mode == "idempotent" and old_c is not None and jobs is not None:
        drop_emptied(spark, path, touched, contrib, metric_type)
    return merged


def _stored_like(new: DataFrame, metric_type: str, now) -> DataFrame:
    """Schema of the stored table for ``new`` rows (adds the audit timestamps when kept)."""
    if now is None:
        return new
    return new.withColumns({"createdAt": F.lit(None).cast("timestamp"), "updatedAt": F.lit(None).cast("timestamp")})


# ------------------------------------------------------------------ reads
def read_metric(table: DataFrame, metric_type: str, q: MetricQuery, metric: str | None = None) -> DataFrame:
    """Stored-metric read: tenant / match / timelines IN / closed intervalFrom range
    (+ metric name for the timeseries), sorted by the table's sort field descending
    with the unique key as a deterministic tiebreak."""
    meta = METRIC_META[metric_type]
    out = table.where(metric_predicate(q))
    if metric and metric_type == "timeseries":
        out = out.where(F.col("metric") == F.lit(metric))
    tiebreak = [c for c in meta.unique if c != meta.sort]
    return out.orderBy(F.desc(meta.sort), *[F.asc(c) for c in tiebreak])


def scan_metric(spark: SparkSession, path: str, metric_type: str, q: MetricQuery, metric: str | None = None) -> DataFrame:
    """``read_metric`` on the stored table at ``path``: tenant and day filters reach the partitions.

    A row lies in the day of its ``intervalFrom``; a timeseries row in that of its bucket, which is no earlier than the
    day before ``intervalFrom`` and has no upper bound here, since a job may be of any length.
    """
    table = read_table(spark, path, with_day=True)
    if table is None:
        raise ValueError(f"no stored table at {path}")
    by_bucket = metric_type == "timeseries"
    if q.start not in (None, ""):
        table = table.where(F.col("intervalDate") >= F.lit((to_utc(q.start) - timedelta(days=int(by_bucket))).date()))
    if q.end not in (None, "") and not by_bucket:
        table = table.where(F.col("intervalDate") <= F.lit(to_utc(q.end).date()))
    return read_metric(table, metric_type, q, metric).drop("intervalDate")


# ------------------------------------------------------------------ T6
def retention_prune(timeseries: DataFrame, now: datetime | str,
                    days: int = TIMESERIES_RETENTION_DAYS) -> DataFrame:
    """Timeseries rows whose ``intervalFrom`` is older than ``now - days`` expire."""
    cutoff = to_utc(now) - timedelta(days=days)
    return timeseries.where(F.col("intervalFrom") >= ts_lit(cutoff))


def expire_table(spark: SparkSession, path: str, now: datetime | str, metric_type: str = "timeseries",
                 days: int = TIMESERIES_RETENTION_DAYS) -> None:
    """Remove expired rows from the stored table and from its contributions (else the next upsert of that
    day would bring them back); only partitions with an expired row are rewritten."""
    cutoff = to_utc(now) - timedelta(days=days)
    for at in (path.rstrip("/"), path.rstrip("/") + "_contrib"):
        table = read_table(spark, at, with_day=True)
        if table is None:
            continue
        old = table.where(F.col("intervalFrom") < ts_lit(cutoff))
        touched = cut_lineage(old.select("tenantId", "intervalDate").distinct())
        rows = table.join(touched, ["tenantId", "intervalDate"], "left_semi").drop("intervalDate")
        kept = cut_lineage(retention_prune(rows, now, days))
        write_table(kept, at, metric_type)
        drop_emptied(spark, at, touched, kept, metric_type)

"""Run log and job status as plain tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.logic import level_at_least
from .ordering import keep_latest

# State of a job without events, and the states events lead to.
IDLE, RUNNING, READY, ERROR = "idle", "running", "ready", "error"

STATUS_FIELDS = ("state", "stage", "message", "processed", "total")


def job_status(events: DataFrame, jobs: DataFrame | None = None) -> DataFrame:
    """Latest status per job from its status events.

    ``events`` has job, ts, seq and the status fields. Start and end are the last event that
    began a run and the last that ended one; a start clears the end. With ``jobs`` those
    without events are shown as idle. One partial aggregation per job, no per-job sort.
    """
    at = F.struct("ts", "seq")
    last = F.max_by(F.struct(*STATUS_FIELDS, "ts"), at)
    started = F.max(F.when(F.col("began"), at))
    finished = F.max(F.when(F.col("state").isin(READY, ERROR), at))
    status = events.groupBy("job").agg(last.alias("s"), started.alias("b"), finished.alias("f")).select(
        "job",
        *[F.col(f"s.{c}").alias(c) for c in STATUS_FIELDS],
        F.col("b.ts").alias("started_at"),
        F.col("s.ts").alias("updated_at"),
        F.when(F.col("b").isNull() | (F.col("f") > F.col("b")), F.col("f.ts")).alias("finished_at"),
    )
    if jobs is None:
        return status
    known = jobs.select("job").distinct().join(status, "job", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast(status.schema[c].dataType))
    return known.withColumns(
        {"state": F.coalesce("state", F.lit(IDLE)), "processed": zero("processed"), "total": zero("total")}
    )


def log_at_least(log: DataFrame, minimum: str) -> DataFrame:
    """Entries the level threshold lets through."""
    return log.where(level_at_least(F.col("level"), minimum))


def log_latest(log: DataFrame, n: int = 100, levels: Sequence[str] | None = None, order: Sequence[str] = ("created_at desc", "id desc")) -> DataFrame:
    """Newest n entries, optionally of some levels only."""
    from .filters import sort_columns

    rows = log.where(F.col("level").isin(*[level.lower() for level in levels])) if levels else log
    return rows.orderBy(*sort_columns(order)).limit(n)


def log_retain(
    log: DataFrame, n: int, per: str = "job", order: Sequence[str] = ("created_at desc", "id desc"), spread: Sequence[str] = ("id",)
) -> DataFrame:
    """The newest n entries of each job; 0 keeps everything.

    For an n that Spark does not cut by before the shuffle, groups are cut in parts first, by the columns ``spread``.
    """
    return keep_latest(log, [per], order, n, spread=spread if n > 1000 else ()) if n > 0 else log


def log_clear(log: DataFrame, job: str) -> DataFrame:
    return log.where(~F.col("job").eqNullSafe(job))


def record_changes(stats: DataFrame) -> DataFrame:
    """Adds the rows neither inserted, updated nor deleted, never below zero."""
    rest = F.col("total") - F.col("inserted") - F.col("updated") - F.col("deleted")
    return stats.withColumn("unchanged", F.greatest(F.lit(0).cast("bigint"), rest))


def progress_percent(processed: Column, total: Column) -> Column:
    return F.when(total > 0, F.floor(processed * 100 / total)).otherwise(0).cast("bigint")

"""Queries for the run log and the job status."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.logic import decode_context, encode_context
from ..operators import run_log
from ..sources.logs import read_run_log, write_run_log
from . import catalog as cat
from .base import query, scratch, sql_iso, table


@query("log_top_n", f"""
WITH l AS ({cat.LOG})
SELECT 'all' AS view, id, level, created_at FROM (SELECT * FROM l ORDER BY created_at DESC, id DESC LIMIT 100)
UNION ALL SELECT 'errors', id, level, created_at FROM (SELECT * FROM l WHERE level IN ('error', 'warning') ORDER BY created_at DESC, id DESC LIMIT 40)""")
def log_top_n(spark, d):
    log = cat.log(spark, d).select("id", "level", "created_at")
    newest = run_log.log_latest(log, 100).select(F.lit("all").alias("view"), "*")
    return newest.unionByName(run_log.log_latest(log, 40, ["ERROR", "warning"]).select(F.lit("errors").alias("view"), "*"))


@query("log_retention", f"""
WITH l AS ({cat.LOG})
SELECT id, job, level, created_at FROM (SELECT *, row_number() OVER (PARTITION BY job ORDER BY created_at DESC, id DESC) AS n FROM l) WHERE n <= 20""")
def log_retention(spark, d):
    return run_log.log_retain(cat.log(spark, d), 20).select("id", "job", "level", "created_at")


@query("log_retention_large", """
SELECT l_orderkey, l_linenumber, l_returnflag FROM (
  SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey DESC, l_linenumber DESC) AS n FROM lineitem) WHERE n <= 2000""")
def log_retention_large(spark, d):
    """Few groups, each with a large share of the rows, and a limit above Spark's early cut."""
    from ..operators.ordering import keep_latest

    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    return keep_latest(rows, ["l_returnflag"], ["l_orderkey desc", "l_linenumber desc"], 2000, spread=["l_orderkey", "l_linenumber"])


@query("log_clear", f"WITH l AS ({cat.LOG}) SELECT id, job FROM l WHERE job <> 'job8'")
def log_clear(spark, d):
    return run_log.log_clear(cat.log(spark, d), "job8").select("id", "job")


@query("log_threshold", f"""
WITH l AS ({cat.LOG})
SELECT 'warning' AS minimum, id FROM l WHERE level IN ('warning', 'error') UNION ALL SELECT 'error', id FROM l WHERE level = 'error'
UNION ALL SELECT 'info', id FROM l""")
def log_threshold(spark, d):
    log = cat.log(spark, d).select("id", "level")
    views = [run_log.log_at_least(log, m).select(F.lit(m).alias("minimum"), "id") for m in ("warning", "error", "info")]
    return views[0].unionByName(views[1]).unionByName(views[2])


@query("log_context", """
SELECT event_id, json_extract_string(props, '$.k') AS k, '{"k":"' || json_extract_string(props, '$.k') || '"}' AS encoded,
       'not json ' || event_type AS plain, CAST(NULL AS VARCHAR) AS nothing FROM events""")
def log_context(spark, d):
    context = decode_context(F.col("props"))
    plain = decode_context(F.concat(F.lit("not json "), "event_type"))
    return table(spark, d, "events").select(
        "event_id", context["fields"]["k"].alias("k"), encode_context(context["fields"]).alias("encoded"), plain["text"].alias("plain"),
        encode_context(F.map_filter(context["fields"], lambda k, v: v.isNull())).alias("nothing"),
    )


@query("job_status", f"""
WITH e AS (SELECT 'job' || user_id AS job, event_id, {sql_iso('ts')} AS ts, event_type, value FROM events),
s AS (SELECT *, CASE event_type WHEN 'error' THEN 'error' WHEN 'purchase' THEN 'ready' ELSE 'running' END AS state,
             row_number() OVER (PARTITION BY job ORDER BY ts DESC, event_id DESC) AS n FROM e),
b AS (SELECT job, arg_max(ts, event_id) AS ts, max(event_id) AS id FROM e WHERE event_type = 'signup' GROUP BY job),
f AS (SELECT job, arg_max(ts, event_id) AS ts, max(event_id) AS id FROM e WHERE event_type IN ('error', 'purchase') GROUP BY job)
SELECT j.job, coalesce(s.state, 'idle') AS state, s.event_type AS stage, s.ts AS updated_at, b.ts AS started_at,
       CASE WHEN b.id IS NULL OR f.id > b.id THEN f.ts END AS finished_at, CAST(coalesce(floor(s.value), 0) AS BIGINT) AS processed
FROM (SELECT 'job' || user_id AS job FROM events UNION SELECT 'job' || c_custkey FROM customer) j LEFT JOIN (SELECT * FROM s WHERE n = 1) s ON j.job = s.job LEFT JOIN b ON j.job = b.job LEFT JOIN f ON j.job = f.job""")
def job_status(spark, d):
    log = cat.log(spark, d)
    kind = F.col("stage")
    value = F.floor(F.substring_index("message", " ", -1).cast("double"))
    events = log.select(
        "job", F.col("created_at").alias("ts"), F.col("id").alias("seq"), "stage", "message",
        F.when(kind == "error", "error").when(kind == "purchase", "ready").otherwise("running").alias("state"),
        value.alias("processed"), F.lit(100).cast("bigint").alias("total"), (kind == "signup").alias("began"),
    )
    known = log.select("job").unionByName(table(spark, d, "customer").select(F.concat(F.lit("job"), F.col("c_custkey").cast("string")).alias("job")))
    status = run_log.job_status(events, known)
    return status.select("job", "state", "stage", "updated_at", "started_at", "finished_at", "processed")


@query("log_read_tail", f"""
WITH l AS ({cat.LOG})
SELECT created_at AS timestamp, stage AS operation, level, message, json_extract_string(context, '$.k') AS k
FROM l WHERE created_at LIKE '2024-01-02%' AND level IN ('error', 'warning') ORDER BY created_at DESC, stage DESC, message DESC LIMIT 50""")
def log_read_tail(spark, d):
    """The events written as a run log, and the end of one day read back."""
    root = scratch(spark, "run-log")
    log = cat.log(spark, d).select(
        F.col("created_at").alias("timestamp"), F.col("stage").alias("operation"), "level", "message",
        F.lit("1").alias("mapping_version"), decode_context(F.col("context"))["fields"].alias("context"),
    )
    write_run_log(log.repartition(8), root, "warning")
    tail = read_run_log(spark, root, "2024-01-02", 50)
    return tail.select("timestamp", "operation", "level", "message", F.col("context")["k"].alias("k"))

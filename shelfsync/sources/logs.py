"""Run log as JSON lines, one folder per day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.run_log import log_at_least

# Fixed value: fields of a log line.
LOG_SCHEMA = (
    "timestamp string, operation string, level string, message string, mapping_version string, "
    "context map<string,string>"
)


def write_run_log(log: DataFrame, path: str, minimum: str = "info") -> None:
    """Append the entries the threshold lets through under the day of their timestamp."""
    rows = log_at_least(log.withColumn("level", F.lower("level")), minimum)
    rows.withColumn("day", F.substr("timestamp", F.lit(1), F.lit(10))).write.mode("append").partitionBy("day").json(path)


def read_run_log(spark: SparkSession, path: str, day: str, limit: int | None = None) -> DataFrame:
    """Entries of a day, the last ``limit`` if given; lines that are not JSON are skipped.

    The day is a partition, so only its folder is read.
    """
    rows = (
        spark.read.schema(LOG_SCHEMA + ", day string").option("mode", "DROPMALFORMED").json(path)
        .where(F.col("day") == day)
        .drop("day")
    )
    if not limit:
        return rows
    newest = [F.desc(c) for c in ("timestamp", "operation", "message")]
    return rows.orderBy(*newest).limit(limit)

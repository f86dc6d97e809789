"""Upload queue and copy plans. Planning is relational; only the copy itself touches files."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import is_blank

# Outcomes of a transfer.
DISABLED, MISSING, TOO_LARGE, COPIED = "disabled", "missing", "too_large", "copied"

DEFAULT_MAX_SIZE = 104857600


@dataclass(frozen=True)
class QueueSpec:
    """Columns of a queue table. A flag ``upload`` is pending at 1, a flag ``uploaded`` at 0."""

    id: str = "media_id"
    title: str | None = None
    filename: str = "file_name"
    stored_file: str = "stored_file"
    stored_path: str = "stored_path"
    hash: str = "hash"
    flag: str = "upload"
    flag_pending: int | None = None
    flag_cleared: int | None = None
    kind: str | None = "kind"
    kind_value: str | None = None

    @property
    def pending_value(self) -> int:
        return (1 if self.flag == "upload" else 0) if self.flag_pending is None else self.flag_pending

    @property
    def cleared_value(self) -> int:
        return (0 if self.flag == "upload" else 1) if self.flag_cleared is None else self.flag_cleared


def pending(df: DataFrame, spec: QueueSpec) -> DataFrame:
    """Rows waiting for upload by id, with the stored file filled from file name or title."""
    rows = df.where(F.col(spec.flag) == spec.pending_value)
    if spec.kind and spec.kind_value is not None:
        rows = rows.where(F.col(spec.kind) == spec.kind_value)
    filled = lambda c: F.when(F.col(c) != "", F.col(c))
    fallbacks = [filled(spec.stored_file), filled(spec.filename)] + ([F.col(spec.title)] if spec.title else [])
    stored = F.coalesce(*fallbacks, F.lit(""))
    path = F.coalesce(F.col(spec.stored_path), F.lit(""))
    return rows.select(
        F.col(spec.id).cast("bigint").alias("id"),
        *([F.coalesce(F.col(spec.title), F.lit("")).alias("title")] if spec.title else []),
        F.coalesce(F.col(spec.filename), F.lit("")).alias("filename"),
        stored.alias("stored_file"),
        path.alias("stored_path"),
        F.col(spec.hash).alias("hash"),
    ).orderBy("id")


def relative_name() -> Column:
    """Path below the source folder of a pending row."""
    folder = F.trim(F.col("stored_path"), F.lit("/"))
    return F.concat_ws("/", F.when(folder != "", folder), F.col("stored_file"))


def mark_done(df: DataFrame, done: DataFrame, spec: QueueSpec) -> DataFrame:
    """Clear the flag of the rows whose id is in ``done``."""
    ids = done.select(F.col(done.columns[0]).cast("bigint").alias("__done")).distinct()
    joined = df.join(ids, df[spec.id].cast("bigint") == F.col("__done"), "left")
    cleared = F.lit(spec.cleared_value).cast(df.schema[spec.flag].dataType)
    flag = F.when(F.col("__done").isNotNull(), cleared).otherwise(df[spec.flag])
    return joined.select(*[flag.alias(c) if c == spec.flag else df[c] for c in df.columns])


def classify_transfer(rows: DataFrame, files: DataFrame, max_size: int = DEFAULT_MAX_SIZE, enabled: bool = True) -> DataFrame:
    """Pending rows with their outcome, size and relative path.

    ``files`` is an inventory with relative_path and size.
    """
    if not enabled:
        return rows.withColumns(
            {"relative_path": relative_name(), "size": F.lit(None).cast("bigint"), "outcome": F.lit(DISABLED)}
        )
    known = files.select(F.col("relative_path").alias("__path"), F.col("size").cast("bigint").alias("size"))
    joined = rows.withColumn("relative_path", relative_name()).join(
        known, F.col("relative_path") == F.col("__path"), "left"
    )
    outcome = (
        F.when(F.col("__path").isNull(), MISSING).when(F.col("size") > max_size, TOO_LARGE).otherwise(COPIED)
    )
    return joined.withColumn("outcome", outcome).drop("__path")


def queue_summary(outcomes: DataFrame) -> DataFrame:
    """One row: total, transferred, failed, skipped and bytes."""
    is_ = lambda *names: F.count_if(F.col("outcome").isin(*names))
    return outcomes.agg(
        F.count("*").alias("total"),
        is_(COPIED).alias("transferred"),
        is_(MISSING, TOO_LARGE).alias("failed"),
        is_(DISABLED).alias("skipped"),
        F.coalesce(F.sum(F.when(F.col("outcome") == COPIED, F.col("size"))), F.lit(0)).alias("bytes"),
    )


def transfer_errors(outcomes: DataFrame) -> DataFrame:
    """The failed rows. They stay a table, since a bad run may fail as a whole."""
    return outcomes.where(F.col("outcome").isin(MISSING, TOO_LARGE)).select(
        "id", "filename", F.col("outcome").alias("error")
    )


def example_paths(copied: DataFrame, path: str = "target", n: int = 5) -> DataFrame:
    """The first few paths as one array row; each task contributes at most n."""
    return copied.select(F.col(path).alias("path")).orderBy("path").limit(n).agg(
        F.array_sort(F.collect_list("path")).alias("examples")
    )


def file_copy_plan(inventory: DataFrame, present: DataFrame, only_when_changed: bool = True) -> DataFrame:
    """Files to copy. ``inventory`` has source, target and changed; ``present`` the target paths.

    An unchanged file is left out only if its copy exists; rows without a path are dropped.
    """
    rows = inventory.where(~is_blank(F.col("source")) & ~is_blank(F.col("target")))
    if not only_when_changed:
        return rows.select("source", "target")
    there = present.select(F.col(present.columns[0]).alias("__there")).distinct()
    joined = rows.join(there, F.col("target") == F.col("__there"), "left")
    return joined.where(F.col("changed") | F.col("__there").isNull()).select("source", "target")


def tree_copy_plan(files: DataFrame, target: str, max_size: int = DEFAULT_MAX_SIZE) -> DataFrame:
    """Copy plan of a folder: source, target, size and outcome; files over the limit are errors."""
    outcome = F.when(F.col("size") > max_size, TOO_LARGE).otherwise(COPIED)
    return files.select(
        F.col("path").alias("source"),
        F.concat(F.lit(target.rstrip("/") + "/"), F.col("relative_path")).alias("target"),
        F.col("size").cast("bigint").alias("size"),
        outcome.alias("outcome"),
    )


def tree_copy_summary(plan: DataFrame) -> DataFrame:
    copied = F.col("outcome") == COPIED
    return plan.agg(
        F.count_if(copied).alias("files"),
        F.coalesce(F.sum(F.when(copied, F.col("size"))), F.lit(0)).alias("bytes"),
        F.count_if(~copied).alias("errors"),
    )


def _copy_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import os
    import uuid
    from urllib.parse import unquote

    from pyarrow import fs

    def place(uri: str):
        if "://" in uri:
            return fs.FileSystem.from_uri(uri)
        return fs.LocalFileSystem(), unquote(uri[5:]) if uri.startswith("file:") else uri

    def copy(source: str, target: str) -> str | None:
        try:
            from_fs, from_path = place(source)
            to_fs, to_path = place(target)
            to_fs.create_dir(os.path.dirname(to_path), recursive=True)
            part = f"{to_path}.{uuid.uuid4().hex}.part"
            fs.copy_files(from_path, part, source_filesystem=from_fs, destination_filesystem=to_fs)
            to_fs.move(part, to_path)
            return None
        except Exception as error:
            return str(error)

    for batch in batches:
        yield batch.assign(error=[copy(s, t) for s, t in zip(batch["source"], batch["target"])])


def execute_plan(plan: DataFrame) -> DataFrame:
    """Copy the files of a plan on the executors; the result has an error per failed file.

    A file is written under a passing name and moved over the target, so a task that runs
    again after a lost executor, or twice, leaves the same complete file.
    """
    return plan.select("source", "target").mapInPandas(
        _copy_batches, "source string, target string, error string"
    )

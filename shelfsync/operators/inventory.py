"""Sync of a file inventory into its vault table, and the copies that follow from it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.compare import file_token
from ..functions.paths import vault_name, vault_path
from .delta import INSERT, UPDATE
from .sync import KEPT, ORPHAN, EntitySpec
from .work_queue import file_copy_plan

# Columns of a vault table, and those whose change counts.
VAULT_COLUMNS = (
    "file_name", "checksum", "size", "mtime", "ext", "mime", "source_path", "stored_file", "stored_path", "stored_at", "change", "updated_at",
)
VAULT_DELTA = ("checksum", "size", "mime")


def file_entity(
    name: str,
    now: str,
    pattern: str = "{file_name}",
    algo: str = "mtime_size",
    folder: Column | None = None,
    delta: Sequence[str] = VAULT_DELTA,
) -> EntitySpec:
    """Sync job for the rows of ``scan_files``. The time of storing is set on new and changed files."""
    c = F.col
    known = {n: c(n) for n in ("path", "relative_path", "dir", "file_name", "name_stem", "ext", "size", "mtime", "mime")}
    stored = {"change": 1, "stored_at": now}
    return EntitySpec(
        name=name,
        source=name,
        target=name,
        columns={
            "file_name": c("file_name"),
            "checksum": file_token(c("mtime"), c("size"), algo),
            "size": c("size"),
            "mtime": c("mtime"),
            "ext": c("ext"),
            "mime": c("mime"),
            "source_path": c("path"),
            "stored_file": vault_name(pattern, known, c("ext")),
            "stored_path": F.lit("") if folder is None else folder,
            "stored_at": F.lit(None).cast("string"),
            "updated_at": now,
        },
        keys=("file_name",),
        delta=delta,
        on_insert=stored,
        on_changed=stored,
        on_unchanged={"change": 0},
        order=("path",),
    )


def vault_copy_plan(classified: DataFrame, base: str, present: DataFrame, only_when_changed: bool = True) -> DataFrame:
    """Copies due after a sync: new and changed files, and those whose copy is missing."""
    files = classified.where(~F.col("action").isin(KEPT, ORPHAN)).select(
        F.col("source_path").alias("source"),
        vault_path(base, F.col("stored_path"), F.col("stored_file")).alias("target"),
        F.col("action").isin(INSERT, UPDATE).alias("changed"),
    )
    return file_copy_plan(files, present, only_when_changed)

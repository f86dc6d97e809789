"""Projection of source rows onto target tables, and the row rules that go with it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import is_blank


def as_column(value: Any) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def map_columns(df: DataFrame, mapping: Mapping[str, Any]) -> dict[str, DataFrame]:
    """One DataFrame per target table from ``{"table.column": Column or literal}``.

    A leading database name is accepted and ignored. Each frame is a plain projection of the
    source, so unused source columns are never read.
    """
    tables: dict[str, list[Column]] = {}
    for path, value in mapping.items():
        *_, table, column = path.split(".")
        tables.setdefault(table, []).append(as_column(value).alias(column))
    return {table: df.select(*columns) for table, columns in tables.items()}


def optional(df: DataFrame, column: str) -> Column:
    """The column, or null where the source does not have it."""
    return F.col(column) if column in df.columns else F.lit(None)


def has_keys(keys: Sequence[str]) -> Column:
    return reduce(and_, [~is_blank(F.col(k)) for k in keys], F.lit(True))


def require_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys are all filled; the others are the skipped ones."""
    missing = [k for k in keys if k not in df.columns]
    return df.limit(0) if missing else df.where(has_keys(keys))


def without_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    missing = [k for k in keys if k not in df.columns]
    return df if missing else df.where(~has_keys(keys))


def fill_file_name(df: DataFrame, name: str = "file_name", fallback: str = "hash") -> DataFrame:
    """Blank file names take the hash; rows with neither are dropped."""
    filled = F.when(~is_blank(F.col(name)), F.col(name)).when(~is_blank(F.col(fallback)), F.col(fallback))
    return df.withColumn(name, filled).where(F.col(name).isNotNull())

"""Scans of tables declared as source specs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.numbers import iso_time
from ..operators.filters import apply_filters, sort_columns


@dataclass(frozen=True)
class SourceTable:
    """Source table: fields as a list of columns or ``{alias: column}``, filter and order."""

    table: str
    fields: Sequence[str] | Mapping[str, str]
    default_filter: Mapping[str, Any] = field(default_factory=dict)
    order: Sequence[str] = ()
    keys: Sequence[str] = ()
    ignore_case: bool = False


def project(df: DataFrame, spec: SourceTable) -> DataFrame:
    """Filter, order and select; filter and columns reach the scan."""
    if not spec.fields:
        raise ValueError(f"no fields declared for table {spec.table}")
    pairs = spec.fields.items() if isinstance(spec.fields, Mapping) else [(c, c) for c in spec.fields]
    rows = apply_filters(df, spec.default_filter, spec.ignore_case)
    if spec.order:
        rows = rows.orderBy(*sort_columns(spec.order))
    return rows.select(*[F.col(column).alias(alias) for alias, column in pairs])


def scan_table(spark: SparkSession, spec: SourceTable, root: str, format: str = "parquet") -> DataFrame:
    return project(spark.read.format(format).load(f"{root.rstrip('/')}/{spec.table}"), spec)


def iso_dates(df: DataFrame) -> DataFrame:
    """Every date and time column as ISO-8601 text."""
    return df.select(
        *[
            iso_time(F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


# JDBC URL form and driver class per kind of database.
JDBC = {
    "sqlserver": ("jdbc:sqlserver://{host}:{port};databaseName={database}", "com.microsoft.sqlserver.jdbc.SQLServerDriver"),
    "mysql": ("jdbc:mysql://{host}:{port}/{database}", "com.mysql.cj.jdbc.Driver"),
    "sqlite": ("jdbc:sqlite:{database}", "org.sqlite.JDBC"),
}


def jdbc_options(kind: str, database: str, host: str = "", port: int = 0, **options: Any) -> dict[str, str]:
    """Reader options; pass partitionColumn, lowerBound, upperBound and numPartitions for a parallel scan."""
    url, driver = JDBC[kind]
    base = {"url": url.format(host=host, port=port, database=database), "driver": driver, "fetchsize": "10000"}
    return {**base, **{k: str(v) for k, v in options.items()}}


def scan_jdbc(spark: SparkSession, spec: SourceTable, options: Mapping[str, str], one_task: bool = False) -> DataFrame:
    """Filtered, pruned database scan; Spark pushes the filter and the columns down.

    Without a partition column the whole table comes through one task; that has to be asked for.
    """
    if "partitionColumn" not in options and not one_task:
        raise ValueError(f"{spec.table}: name a partition column and its bounds, or pass one_task=True for a small table")
    rows = spark.read.format("jdbc").options(**options).option("dbtable", spec.table).load()
    return iso_dates(project(rows, spec))

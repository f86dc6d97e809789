"""Target tables: declared columns, merge keys, schema growth and constraint checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

# Declared column types and what they are stored as; anything else is text.
COLUMN_TYPES = {
    "int": T.LongType(),
    "integer": T.LongType(),
    "smallint": T.LongType(),
    "bigint": T.LongType(),
    "tinyint": T.LongType(),
    "real": T.DoubleType(),
    "float": T.DoubleType(),
    "double": T.DoubleType(),
    "decimal": T.DoubleType(),
    "numeric": T.DoubleType(),
    "bool": T.IntegerType(),
    "boolean": T.IntegerType(),
    "blob": T.BinaryType(),
}


@dataclass(frozen=True)
class Field:
    """Column of a target table. ``required`` is checked, ``default`` fills a new column."""

    type: str = "text"
    default: Any = None
    required: bool = False
    auto_increment: bool = False

    def spark_type(self) -> T.DataType:
        return COLUMN_TYPES.get(self.type.lower(), T.StringType())


@dataclass(frozen=True)
class TargetTable:
    """Declared target. Fields are a list of names (all text) or a map of definitions."""

    name: str
    fields: Sequence[str] | Mapping[str, Field]
    explicit_unique: Sequence[str] | None = None
    unique_key: Sequence[str] | None = None
    business_key: Sequence[str] = ()
    unique_constraint: Sequence[str] | None = None
    legacy_keys: Sequence[str] | None = None
    primary_key: Sequence[str] = ()
    keys: Sequence[str] = ()

    def definitions(self) -> dict[str, Field]:
        if isinstance(self.fields, Mapping):
            return dict(self.fields)
        return {name: Field() for name in self.fields}

    def merge_keys(self) -> list[str]:
        """The first declared key in this order decides what a row is matched by."""
        explicit = next((k for k in (self.explicit_unique, self.unique_key) if k is not None), self.keys)
        constraint = self.keys if self.unique_constraint is None else self.unique_constraint
        legacy = self.keys if self.legacy_keys is None else self.legacy_keys
        for candidate in (explicit, self.business_key, constraint, legacy, self.primary_key):
            if candidate:
                return list(dict.fromkeys(candidate))
        return []

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, f.spark_type()) for n, f in self.definitions().items()])


def create_table(spark: SparkSession, table: TargetTable) -> DataFrame:
    """Empty table with the declared columns."""
    return spark.createDataFrame([], table.schema())


def all_text(df: DataFrame) -> DataFrame:
    """Shop tables store every column as text."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def add_missing_columns(df: DataFrame, table: TargetTable, flags: Sequence[str] = ()) -> DataFrame:
    """Columns the table lacks, filled with their default; null flags become 0."""
    added = [
        F.lit(f.default).cast(f.spark_type()).alias(n)
        for n, f in table.definitions().items()
        if n not in df.columns
    ]
    grown = df.select("*", *added)
    zeros = {c: F.coalesce(F.col(c), F.lit(0).cast(grown.schema[c].dataType)) for c in flags if c in grown.columns}
    return grown.withColumns(zeros) if zeros else grown


def check_unique(df: DataFrame, keys: Sequence[str], where: Column | None = None) -> DataFrame:
    """Keys that occur more than once, with their count. Keys holding a null never clash."""
    rows = df if where is None else df.where(where)
    filled = reduce(and_, [F.col(k).isNotNull() for k in keys])
    return rows.where(filled).groupBy(*keys).agg(F.count("*").alias("rows")).where("rows > 1")


def one_of(column: str, *values: Any) -> Column:
    return F.col(column).isin(*values)


def required(column: str) -> Column:
    return F.coalesce(F.col(column).isNotNull(), F.lit(False))


def check_constraints(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """Violations per constraint, in one scan. A null result of a check passes."""
    counts = df.agg(*[F.count_if(~c).alias(n) for n, c in checks.items()])
    return counts.unpivot([], list(checks), "constraint", "violations")


def fk_violations(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose filled reference has no parent."""
    keys = parent.select(F.col(key).alias(column))
    return child.where(F.col(column).isNotNull()).join(keys, column, "left_anti").select(*child.columns)


def introspect(tables: Mapping[str, tuple[DataFrame, TargetTable | None]]) -> DataFrame:
    """One row per column: table, position, name, type, nullable, default, key."""
    rows = []
    spark = None
    for name, (df, declared) in tables.items():
        spark = df.sparkSession
        keys = declared.merge_keys() if declared else []
        fields = declared.definitions() if declared else {}
        for i, f in enumerate(df.schema.fields, 1):
            default = fields[f.name].default if f.name in fields else None
            rows.append(
                (name, i, f.name, f.dataType.simpleString(), f.nullable, None if default is None else str(default), f.name in keys)
            )
    return spark.createDataFrame(
        rows, "table string, position int, name string, type string, nullable boolean, default string, key boolean"
    )


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table; each count is read from file statistics or a column-free scan."""
    counts = [df.agg(F.count("*").alias("rows")).select(F.lit(n).alias("table"), "rows") for n, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)

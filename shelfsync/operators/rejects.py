"""Values that do not fit the type of their target column: found in the pass that writes, and kept as rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

REJECTS = "entity string, row string, column string, value string, reason string"


_WIDTH = {T.ByteType: 1, T.ShortType: 2, T.IntegerType: 3, T.LongType: 4}


def fallible(old: T.DataType, new: T.DataType) -> bool:
    """Whether a cast between two types can lose a filled value."""
    if old == new or isinstance(old, T.NullType) or isinstance(new, T.StringType):
        return False
    if type(old) in _WIDTH:
        return not (isinstance(new, (T.FloatType, T.DoubleType)) or _WIDTH.get(type(new), 0) >= _WIDTH[type(old)])
    return not (isinstance(old, T.FloatType) and isinstance(new, T.DoubleType))


def refused(kinds: Mapping[str, T.DataType]) -> Column:
    """The columns of a row whose filled value cannot be cast, as an array of column, value and reason."""
    found = [
        F.when(
            F.col(c).isNotNull() & F.col(c).try_cast(k).isNull(),
            F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"), F.lit(f"not a {k.simpleString()}").alias("reason")),
        )
        for c, k in kinds.items()
    ]
    none = F.from_json(F.lit("[]"), "array<struct<column:string,value:string,reason:string>>")
    return F.filter(F.array(*found), lambda x: x.isNotNull()) if found else none


def misfits(rows: DataFrame, target: DataFrame) -> Column:
    """``refused`` for the columns of ``rows`` that have another type in the target."""
    kinds = {f.name: f.dataType for f in target.schema.fields if f.name in rows.columns}
    return refused({c: k for c, k in kinds.items() if fallible(rows.schema[c].dataType, k)})


def listed(rows: DataFrame, keys: Sequence[str], entity: str = "", column: str = "__rejects") -> DataFrame:
    """One row for every refused value: entity, row (its keys as JSON), column, value as text, and reason."""
    keyed = F.to_json(F.struct(*[F.col(k).alias(k) for k in keys]))
    found = rows.where(F.size(column) > 0).select(keyed.alias("row"), F.explode(column).alias("r"))
    return found.select(F.lit(entity).alias("entity"), "row", "r.column", "r.value", "r.reason")


def rejects(rows: DataFrame, target: DataFrame, keys: Sequence[str], entity: str = "") -> DataFrame:
    """The refused values of changes to a target, with their keys as the changes give them."""
    return listed(rows.withColumn("__rejects", misfits(rows, target)), keys, entity)


def accepted(rows: DataFrame, target: DataFrame) -> DataFrame:
    """The changes all of whose values fit, in the types of the target."""
    kinds = {f.name: f.dataType for f in target.schema.fields}
    good = rows.withColumn("__rejects", misfits(rows, target)).where(F.size("__rejects") == 0)
    return good.select(*[F.col(c).try_cast(kinds[c]).alias(c) if c in kinds else F.col(c) for c in rows.columns])

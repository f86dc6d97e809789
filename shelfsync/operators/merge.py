"""Keyed merges. Each returns the new content of the target; writing it is one snapshot."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from .ordering import assign_ids, first_wins, last_wins
from .rejects import accepted


def same_keys(left: str, right: str, keys: Sequence[str]) -> Column:
    return reduce(and_, [F.col(f"{left}.{k}") == F.col(f"{right}.{k}") for k in keys])


def _need_keys(keys: Sequence[str]) -> None:
    if not keys:
        raise ValueError("the target has no unique key")


def upsert(
    target: DataFrame, changes: DataFrame, keys: Sequence[str], small_changes: bool = False, order: Sequence[str] = ()
) -> DataFrame:
    """Insert new keys; on known keys overwrite only the columns the changes have.

    An explicit null overwrites, a column missing from the changes keeps its value. Of changes with one
    key the last in ``order`` counts, else the last in the order of their columns. A change with a value that does not fit its
    column is left out, so it never overwrites; ``rejects.rejects`` lists such values. The default is one full outer join. With ``small_changes`` the
    target is scanned twice but, as long as Spark can broadcast the changes, never shuffled.
    """
    _need_keys(keys)
    helpers = [c.split()[0] for c in order if c.split()[0] not in target.columns]
    unknown = set(changes.columns) - set(target.columns) - set(helpers)
    if unknown:
        raise ValueError(f"columns not in the target: {sorted(unknown)}")
    changes = last_wins(accepted(changes, target), keys, order).drop(*helpers)
    new = changes.withColumn("__hit", F.lit(True)).alias("new")
    old = target.alias("old")
    on = same_keys("old", "new", keys)

    def merged(column: str) -> Column:
        if column in keys:
            value = F.coalesce(F.col(f"old.{column}"), F.col(f"new.{column}"))
        elif column in changes.columns:
            value = F.when(F.col("new.__hit"), F.col(f"new.{column}")).otherwise(F.col(f"old.{column}"))
        else:
            value = F.col(f"old.{column}")
        return value.alias(column)

    if not small_changes:
        return old.join(new, on, "full_outer").select(*[merged(c) for c in target.columns])
    patched = old.join(new, on, "left").select(*[merged(c) for c in target.columns])
    known = target.select(*keys).join(changes.select(*keys), list(keys), "left_semi")
    added = changes.join(known, list(keys), "left_anti")
    return patched.unionByName(added, allowMissingColumns=True).select(*target.columns)


def replace_merge(
    target: DataFrame, staging: DataFrame, keys: Sequence[str], order: Sequence[str] = (),
    id_column: str | None = None, max_id: int = 0,
) -> DataFrame:
    """Rows with a staged key are replaced as a whole: columns not staged become null.

    The last staged row per key wins, in ``order`` or else in the order of the columns. With ``id_column`` replaced and new rows
    get fresh ids above ``max_id``, in the same order. A staged row with a value that does not fit its column is left out, and
    the row it would have replaced stays.
    """
    staged = accepted(staging, target)
    if not keys:
        return target.unionByName(staged, allowMissingColumns=True)
    staged = last_wins(staged, keys, order)
    if id_column:
        staged = assign_ids(staged, order or list(keys), max_id, id_column)
    kept = target.join(staged.select(*keys), list(keys), "left_anti")
    return kept.unionByName(staged, allowMissingColumns=True).select(*target.columns)


def append(target: DataFrame, rows: DataFrame) -> DataFrame:
    return target.unionByName(rows, allowMissingColumns=True).select(*target.columns)


def insert_ignore(target: DataFrame, rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Add rows whose key is not there yet; of repeated keys the first is added."""
    _need_keys(keys)
    fresh = first_wins(rows, keys, order).join(target.select(*keys), list(keys), "left_anti")
    return append(target, fresh)


def delete_by_key(target: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    _need_keys(keys)
    return target.join(rows.select(*keys), list(keys), "left_anti").select(*target.columns)


def union_first_wins(frames: Sequence[DataFrame], keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows of all frames, one per key: earlier frames win, then the given order."""
    tagged = [f.withColumn("__rank_of", F.lit(i)) for i, f in enumerate(frames)]
    return first_wins(reduce(DataFrame.unionByName, tagged), keys, ["__rank_of", *order]).drop("__rank_of")


def delta_export(df: DataFrame, flag: str = "change") -> tuple[DataFrame, DataFrame]:
    """Rows flagged as changed, and the table with the flag cleared."""
    cleared = F.lit(0).cast(df.schema[flag].dataType)
    return df.where(F.col(flag) == 1), df.withColumn(flag, F.coalesce(cleared, F.col(flag)))


def set_where(df: DataFrame, condition: Column, values: Mapping[str, Column]) -> DataFrame:
    """Update columns on the rows that meet a condition."""
    hit = F.coalesce(condition, F.lit(False))
    return df.select(
        *[F.when(hit, values[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in df.columns]
    )

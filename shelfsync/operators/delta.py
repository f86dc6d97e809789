"""Change capture: classification against the stored rows, flag columns, image fan-out."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.compare import delta_changed, loose_ne
from ..functions.text import is_blank
from .mapping import as_column
from .merge import same_keys

INSERT, UPDATE, UNCHANGED = "insert", "update", "unchanged"
FlagSet = Mapping[str, Any]


def attach_existing(changes: DataFrame, target: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Changes (alias ``new``) joined with the stored row (alias ``old``) by key.

    ``new.__new`` and ``old.__old`` tell which side is present. A null key matches nothing.
    """
    new = changes.withColumn("__new", F.lit(True)).alias("new")
    old = target.withColumn("__old", F.lit(True)).alias("old")
    return new.join(old, same_keys("new", "old", keys), how)


def differs(changes: DataFrame, target: DataFrame, fields: Sequence[str]) -> Column:
    """Delta test between the ``new`` and ``old`` side of an attached frame.

    A field that one side lacks is null there.
    """
    pairs = []
    for field in fields:
        kinds = [f.schema[field].dataType if field in f.columns else None for f in (changes, target)]
        sides = [f"{side}.`{field}`" if kind else "NULL" for side, kind in zip(("new", "old"), kinds)]
        known = kinds[0] or kinds[1]
        if known:
            pairs.append((*sides, kinds[0] or known, kinds[1] or known))
    return delta_changed(pairs) if pairs or not fields else F.lit(False)


def action(exists: Column, changed: Column) -> Column:
    return F.when(~exists, INSERT).when(changed, UPDATE).otherwise(UNCHANGED)


def delta_classify(changes: DataFrame, target: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Changes with the column ``action``: insert, update or unchanged."""
    joined = attach_existing(changes, target, keys)
    exists = F.col("old.__old").isNotNull()
    return joined.select(
        *[F.col(f"new.{c}").alias(c) for c in changes.columns],
        action(exists, differs(changes, target, fields)).alias("action"),
    )


def flag_values(
    current: dict[str, Column], when: Column, flags: FlagSet
) -> dict[str, Column]:
    """Columns after one flag set. A value may be a function of the columns set so far."""
    values = dict(current)
    for column, value in flags.items():
        fresh = value(values) if isinstance(value, Callable) and not isinstance(value, Column) else as_column(value)
        kept = values.get(column)
        values[column] = F.when(when, fresh) if kept is None else F.when(when, fresh).otherwise(kept)
    return values


def apply_flags(
    df: DataFrame,
    on_insert: FlagSet | None = None,
    on_changed: FlagSet | None = None,
    on_unchanged: FlagSet | None = None,
    action_column: str = "action",
) -> DataFrame:
    """Set flag columns by action; rows and columns without a rule stay as they are."""
    values = {c: F.col(c) for c in df.columns}
    for name, flags in ((INSERT, on_insert), (UPDATE, on_changed), (UNCHANGED, on_unchanged)):
        values = flag_values(values, F.col(action_column) == name, flags or {})
    return df.select(*[c.alias(n) for n, c in values.items()])


def set_where_different(df: DataFrame, rows: Column, values: Mapping[str, Column], mark: str) -> DataFrame:
    """Set columns on the given rows where that alters the row (loosely compared).

    Column ``mark`` tells the rows that were altered.
    """
    fresh = df.withColumns({f"__set_{n}": v for n, v in values.items()})
    pairs = [(f"`{n}`", f"`__set_{n}`", df.schema[n].dataType, fresh.schema[f"__set_{n}"].dataType) for n in values]
    marked = fresh.withColumn(mark, F.coalesce(rows & delta_changed(pairs), F.lit(False)))
    return marked.select(
        *[
            F.when(F.col(mark), F.col(f"__set_{c}").cast(df.schema[c].dataType)).otherwise(F.col(c)).alias(c)
            if c in values
            else F.col(c)
            for c in df.columns
        ],
        mark,
    )


def row_hash_delta(df: DataFrame, seen: str = "last_seen_hash", imported: str = "last_imported_hash") -> Column:
    """Changed when the hash seen now is not the one of the last import."""
    kinds = df.schema[seen].dataType, df.schema[imported].dataType
    return loose_ne(f"`{seen}`", f"`{imported}`", *kinds)


def fan_out(df: DataFrame, keys: Sequence[str], pattern: str = "Bild{n}", first: int = 1, last: int = 10) -> DataFrame:
    """Numbered columns to rows (keys, n, name): blanks go, of equal names the lowest number stays.

    Done within each row, without a shuffle.
    """
    entries, earlier = [], []
    for n in range(first, last + 1):
        name = F.col(pattern.replace("{n}", str(n)))
        fresh = ~is_blank(name)
        if earlier:
            fresh = fresh & ~name.isin(*[F.coalesce(e, F.lit("")) for e in earlier])
        entries.append(F.when(fresh, F.struct(F.lit(n).alias("n"), name.alias("name"))))
        earlier.append(name)
    rows = df.select(*keys, F.explode(F.array(*entries)).alias("__e")).where(F.col("__e").isNotNull())
    return rows.select(*keys, "__e.n", "__e.name")

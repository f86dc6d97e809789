"""Soft deletion of target rows that no incoming row accounts for."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from .delta import set_where_different
from .mapping import as_column


@dataclass(frozen=True)
class OrphanPolicy:
    """Columns to set on orphans. ``scope`` limits the rows a policy may touch."""

    match_key: Sequence[str]
    set: Mapping[str, Any] = field(default_factory=dict)
    scope: Column | None = None
    allow_empty: bool = False

    def values(self) -> dict[str, Column]:
        return {c: as_column(v) for c, v in self.set.items()}

    def candidates(self) -> Column:
        """Rows the policy looks at: within scope, with a complete match key."""
        filled = reduce(and_, [F.col(k).isNotNull() for k in self.match_key])
        return filled if self.scope is None else filled & self.scope


def anti_join_orphans(target: DataFrame, processed: DataFrame, match_key: Sequence[str]) -> DataFrame:
    """Target rows whose match key is complete and was not processed."""
    filled = reduce(and_, [F.col(k).isNotNull() for k in match_key])
    return target.where(filled).join(processed.select(*match_key), list(match_key), "left_anti")


def orphan_update(target: DataFrame, processed: DataFrame, policies: Sequence[OrphanPolicy]) -> DataFrame:
    """Target with the orphans of each policy updated and marked in column ``orphaned``.

    A row that already has the values is left alone. An empty run is refused unless the
    policy allows it, since it would disable the whole table.
    """
    result = target.withColumn("orphaned", F.lit(False))
    for policy in policies:
        if not policy.allow_empty and processed.isEmpty():
            raise ValueError("no rows were processed: refusing to disable the whole target")
        keys = list(policy.match_key)
        seen = processed.select(*[F.col(k).alias(f"__seen_{k}") for k in keys]).distinct()
        seen = seen.withColumn("__seen", F.lit(True))
        on = reduce(and_, [result[k] == seen[f"__seen_{k}"] for k in keys])
        joined = result.join(seen, on, "left").select(*result.columns, "__seen")
        missing = F.col("__seen").isNull() & policy.candidates()
        result = set_where_different(joined, missing, policy.values(), "__hit").withColumn(
            "orphaned", F.col("orphaned") | F.col("__hit")
        )
        result = result.select(*target.columns, "orphaned")
    return result

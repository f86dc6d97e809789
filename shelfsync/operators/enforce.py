"""Constraints that hold when a table is written: a commit that would break one is withheld, or the rows that break it are set aside."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F

from ..sources.run_cache import RunCache
from .ordering import first_wins
from .schema import TargetTable

WITHHOLD, QUARANTINE = "withhold", "quarantine"


@dataclass(frozen=True)
class Constraints:
    """Rules of one table by name. A check whose result is null passes; a key with a null never clashes, a null reference is allowed."""

    checks: Mapping[str, Column] = field(default_factory=dict)
    unique: Mapping[str, Sequence[str]] = field(default_factory=dict)
    references: Mapping[str, tuple[str, str, str]] = field(default_factory=dict)  # column, parent table, its column

    def names(self) -> list[str]:
        return [*self.checks, *self.unique, *self.references]

    @staticmethod
    def of(table: TargetTable) -> Constraints:
        """What a declared table implies: required columns, and its unique keys."""
        needed = {f"{table.name}.{n} required": F.col(n).isNotNull() for n, f in table.definitions().items() if f.required}
        keys = [list(k) for k in (table.explicit_unique, table.unique_key, table.business_key, table.unique_constraint, table.primary_key) if k]
        unique = {f"{table.name} unique {', '.join(k)}": k for k in keys}
        return Constraints(needed, unique)


class ConstraintViolation(ValueError):
    """Nothing was committed; ``violations`` counts by constraint."""

    def __init__(self, table: str, violations: Mapping[str, int]):
        super().__init__(f"{table}: " + ", ".join(f"{n} ({v})" for n, v in sorted(violations.items())))
        self.violations = dict(violations)


def enforced_write(
    store, name: str, rows: DataFrame, constraints: Constraints, order: Sequence[str] = (), mode: str = WITHHOLD
) -> dict[str, int]:
    """Write a table if its constraints hold. Returns violations by constraint, those broken at least once.

    ``withhold``: one pass writes the rows and counts broken checks; keys and references are then looked up in the key columns
    of what was written, and the commit is left out with ConstraintViolation if any is broken. ``quarantine``: rows that break
    a rule go to the table ``<name>__refused`` with the names of those rules, all others are committed with it. Of rows
    with one key the first in ``order`` that breaks no check stays.
    """
    if hasattr(store, "begin"):
        with store.begin() as change:
            return enforced_write(change, name, rows, constraints, order, mode)
    if mode == WITHHOLD:
        broken = _written_and_counted(store, name, rows, constraints)
        if broken:
            raise ConstraintViolation(name, broken)
        return {}
    if mode != QUARANTINE:
        raise ValueError(f"unknown mode {mode}")
    with RunCache(rows.sparkSession) as kept:
        marked = rows.withColumn("__broken", _failed(constraints.checks)).withColumn("__row", F.monotonically_increasing_id())
        marked = kept.keep(marked)  # row numbers hold once they are written
        violations = kept.keep(_violations(store, marked, constraints, order))
        rules = violations.groupBy("__row").agg(F.array_sort(F.collect_set("rule")).alias("broken_rules"))
        met = marked.join(rules, "__row", "left")
        store.write(name, met.where("broken_rules IS NULL").select(*rows.columns))
        store.write(f"{name}__refused", met.where("broken_rules IS NOT NULL").select(*rows.columns, "broken_rules"))
        return {r["rule"]: r["n"] for r in violations.groupBy("rule").agg(F.count("*").alias("n")).collect()}


def _failed(checks: Mapping[str, Column]) -> Column:
    """Names of the checks that a row breaks."""
    found = [F.when(~F.coalesce(c, F.lit(True)), F.lit(n)) for n, c in checks.items()]
    return F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")


def _written_and_counted(store, name: str, rows: DataFrame, constraints: Constraints) -> dict[str, int]:
    watch = Observation()
    counts = [F.count_if(~F.coalesce(c, F.lit(True))).alias(n) for n, c in constraints.checks.items()]
    written = store.write(name, rows.observe(watch, *counts) if counts else rows)
    broken = {n: v for n, v in watch.get.items()} if counts else {}
    for rule, keys in constraints.unique.items():
        twice = _filled(written, keys).groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
        broken[rule] = twice.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n")).first()["n"]
    for rule, (column, parent, key) in constraints.references.items():
        broken[rule] = _dangling(store, written.select(column), column, parent, key).count()
    return {n: v for n, v in broken.items() if v}


def _filled(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.where(reduce(Column.__and__, [F.col(k).isNotNull() for k in keys]))


def _dangling(store, rows: DataFrame, column: str, parent: str, key: str) -> DataFrame:
    found = store.read(parent).select(F.col(key).alias(column))
    return rows.where(F.col(column).isNotNull()).join(found, column, "left_anti")


def _violations(store, marked: DataFrame, constraints: Constraints, order: Sequence[str]) -> DataFrame:
    """One row for every row and rule that it breaks."""
    found = [marked.select("__row", F.explode("__broken").alias("rule"))]
    fit = marked.where(F.size("__broken") == 0)
    for rule, keys in constraints.unique.items():
        named = [c.split()[0] for c in order if c.split()[0] not in keys]
        narrow = _filled(fit, keys).select(*keys, *named, "__row")
        often = narrow.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").select(*keys)
        repeated = narrow.join(often, list(keys), "left_semi")
        stays = first_wins(repeated, keys, [*order, "__row"]).select("__row")
        found.append(repeated.join(stays, "__row", "left_anti").select("__row", F.lit(rule).alias("rule")))
    for rule, (column, parent, key) in constraints.references.items():
        dangling = _dangling(store, marked.select("__row", column), column, parent, key)
        found.append(dangling.select("__row", F.lit(rule).alias("rule")))
    return reduce(DataFrame.unionByName, found)

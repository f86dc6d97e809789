"""Declared row filters and orders."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F


def _between(c: Column, value: Any) -> Column:
    if not isinstance(value, (list, tuple)) or len(value) != 2:
        raise ValueError("between needs exactly two values")
    return c.between(value[0], value[1])


def _like(c: Column, value: Any, ignore_case: bool) -> Column:
    return c.ilike(value) if ignore_case else c.like(value)


_OPERATORS = {
    "eq": lambda c, v, i: c == v,
    "ne": lambda c, v, i: c != v,
    "lt": lambda c, v, i: c < v,
    "lte": lambda c, v, i: c <= v,
    "le": lambda c, v, i: c <= v,
    "gt": lambda c, v, i: c > v,
    "gte": lambda c, v, i: c >= v,
    "ge": lambda c, v, i: c >= v,
    "like": _like,
    "not_like": lambda c, v, i: ~_like(c, v, i),
    "in": lambda c, v, i: c.isin(*v) if v else F.lit(False),
    "not_in": lambda c, v, i: ~c.isin(*v) if v else F.lit(True),
    "between": lambda c, v, i: _between(c, v),
    "not_null": lambda c, v, i: c.isNotNull(),
    "is_null": lambda c, v, i: c.isNull(),
}


def predicate(column: str, operator: str, value: Any, ignore_case: bool = False) -> Column:
    build = _OPERATORS.get(operator.lower())
    if build is None:
        raise ValueError(f"unknown filter operator {operator!r} for column {column}")
    return build(F.col(column), value, ignore_case)


def filter_condition(rules: Mapping[str, Any], ignore_case: bool = False) -> Column:
    """AND of ``{column: value}`` and ``{column: {operator: value, ...}}`` rules."""
    parts = [
        predicate(column, operator, value, ignore_case)
        for column, rule in rules.items()
        for operator, value in (rule.items() if isinstance(rule, Mapping) else [("eq", rule)])
    ]
    return reduce(and_, parts, F.lit(True))


def apply_filters(df: DataFrame, rules: Mapping[str, Any], ignore_case: bool = False) -> DataFrame:
    return df.where(filter_condition(rules, ignore_case)) if rules else df


def sort_columns(order: Sequence[str]) -> list[Column]:
    """``"name"`` or ``"name desc"``; nulls come first going up and last going down."""
    columns = []
    for entry in order:
        name, _, direction = entry.strip().partition(" ")
        c = F.col(name)
        columns.append(c.desc_nulls_last() if direction.strip().lower() == "desc" else c.asc_nulls_first())
    return columns

"""Column functions by name, and pipes of them."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from . import logic, numbers, rtf, text

Step = Callable[[Column], Column]


def pipe(c: Column, *steps: Step) -> Column:
    """Apply the steps from left to right."""
    return reduce(lambda value, step: step(value), steps, c)


#: Characters of an error's message that are kept.
MESSAGE = 200


class Guarded:
    """A Python function as an Arrow-batched step. A value it fails on stays as it is, and the error is known.

    As a step it gives the value; ``outcome`` gives a struct of value and error (null where there is none).
    """

    def __init__(self, fn: Callable[[str], str], name: str | None = None):
        self.name = name or getattr(fn, "__name__", "function")

        def one(value: str | None) -> tuple[str | None, str | None]:
            if value is None:
                return None, None
            try:
                return fn(value), None
            except Exception as error:
                return value, f"{type(error).__name__}: {error}"[:MESSAGE]

        @F.pandas_udf("value string, error string")
        def batch(values: pd.Series) -> pd.DataFrame:
            return pd.DataFrame([one(v) for v in values], columns=["value", "error"], dtype=object)

        self.outcome: Step = lambda c: batch(c)

    def __call__(self, c: Column) -> Column:
        return self.outcome(c)["value"]


def guarded(fn: Callable[[str], str], name: str | None = None) -> Guarded:
    return Guarded(fn, name)


def error_log(df: DataFrame, calls: Sequence[tuple[Guarded, Column]]) -> DataFrame:
    """What the functions of some calls fail on: function, message, times, and the smallest value as an example.

    One pass over the rows; errors are summed by function and message with map-side combine.
    """
    found = [
        F.struct(F.lit(step.name).alias("function"), step.outcome(c)["error"].alias("message"), c.cast("string").alias("value"))
        for step, c in calls
    ]
    rows = df.select(F.explode(F.array(*found)).alias("e")).select("e.*").where("message IS NOT NULL")
    return rows.groupBy("function", "message").agg(F.count("*").alias("times"), F.min("value").alias("example"))


class Registry:
    """Functions a mapping can name. An unknown name leaves the value unchanged."""

    def __init__(self, steps: dict[str, Step] | None = None):
        self._steps = dict(DEFAULT_STEPS if steps is None else steps)

    def register(self, name: str, step: Step) -> None:
        self._steps[name] = step

    def get(self, name: str) -> Step | None:
        return self._steps.get(name)

    def has(self, name: str) -> bool:
        return name in self._steps

    def apply(self, name: str, c: Column) -> Column:
        step = self.get(name)
        return c if step is None else step(c)

    def pipe(self, c: Column, *names: str) -> Column:
        return reduce(lambda value, name: self.apply(name, value), names, c)


# The names mappings use.
DEFAULT_STEPS: dict[str, Step] = {
    "trim": text.trim,
    "basename": text.basename,
    "rtf_to_html": rtf.rtf_to_html,
    "remove_html": text.remove_html,
    "normalize_title": text.normalize_title,
    "slugify": text.slugify,
    "transform_rtf_to_html": rtf.rtf_to_html,
    "null_if_empty": text.null_if_empty,
    "to_decimal": numbers.to_decimal,
    "to_int": numbers.to_int,
    "bool_to_int": numbers.bool_to_int,
    "tax_map": numbers.tax_map,
    "article_master_flag": logic.article_master_flag,
    "article_master_number": logic.article_master_number,
    "media_detect_type": logic.media_detect_type,
    "media_extract_article": logic.media_extract_article,
    "media_extract_category": logic.media_extract_category,
    "article_meta_title_default": text.meta_default,
    "article_meta_description_default": text.meta_default,
    "category_meta_title_default": text.meta_default,
    "category_meta_description_default": text.meta_default,
}

"""Mixing sources to target weights by iterative proportional fitting.

Tokens are summed up by cells of source, language and topic. Raking scales the cells in turn so that the sums
over each dimension meet their targets; it stops when all do. The factor of its cell makes a document's weight,
and, scaled to the wanted number of tokens, its probability of being drawn. A document is drawn when the
hash of its id lies below that probability, so a repeated run draws the same.

There may be as many cells as sources: above a checked number they stay rows of a table throughout.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .batches import stored, uniform

DIMENSIONS = ("source", "lang", "topic")
NONE = "(none)"
#: Exponents of the usual targets: 1 keeps a dimension's shares of tokens, 0 makes them equal.
FLATTEN = {"source": 0.7, "lang": 0.5, "topic": 0.8}
TOLERANCE = 1e-4
ROUNDS = 60
#: Cells up to which raking runs on the driver (a few megabytes); more cells are raked as a table, to the same factors.
FEW = 50_000


@dataclass(frozen=True)
class Mix:
    """Share of the tokens to draw, targets (dimension, level, share) or exponents for them, and the seed."""

    share: float = 0.5
    flatten: tuple[tuple[str, float], ...] = tuple(FLATTEN.items())
    seed: int = 29


def topic(text: Column) -> Column:
    """A coarse topic by the shape of a text, by the first rule that holds."""
    return (
        F.when(text.isNull() | (F.trim(text) == ""), F.lit("empty"))
        .when(text.contains("{") & text.contains(";"), F.lit("code"))
        .when(text.contains(" | "), F.lit("table"))
        .when(text.contains("@") | text.contains("http"), F.lit("web"))
        .otherwise(F.lit("prose"))
    )


def tokens(text: Column) -> Column:
    """Words between white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long")


def _level(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(NONE))


def described(documents: DataFrame) -> DataFrame:
    """Adds tokens and topic, a topic of its own replaced."""
    return documents.withColumns({"tokens": tokens(F.col("text")), "topic": topic(F.col("text"))})


def targets(cells: DataFrame, flatten: dict[str, float]) -> dict[str, DataFrame]:
    """For each dimension the share of tokens wanted of every level: shares to the given power, made to sum to 1."""
    out = {}
    for name, power in flatten.items():
        levels = cells.groupBy(name).agg(F.sum("tokens").cast("double").alias("n")).withColumn("p", F.pow("n", F.lit(float(power))))
        total = levels.agg(F.sum("p")).first()[0]
        out[name] = levels.select(name, (F.col("p") / F.lit(total or 1.0)).alias("target"))
    return out


def rake(cells: DataFrame, wanted: dict[str, DataFrame]) -> DataFrame:
    """Adds to the cells (`tokens` > 0) the factor that makes the sums of tokens * factor meet the wanted shares.

    The factors of a cell's levels are multiplied; each pass fits one dimension after the other. If the targets contradict
    each other (a level without cells, say), it stops after ROUNDS with the nearest it has.
    """
    total = cells.agg(F.sum("tokens")).first()[0]
    if not total:
        return cells.withColumn("factor", F.lit(1.0))
    if cells.count() <= FEW:
        return _rake_few(cells, wanted, float(total))
    at = cells.withColumn("factor", F.lit(1.0))
    for _ in range(ROUNDS):
        for name, shares in wanted.items():
            now = at.groupBy(name).agg((F.sum(F.col("tokens") * F.col("factor")) / F.lit(float(total))).alias("now"))
            step = now.join(shares, name, "left").select(
                name, F.when(F.col("now") > 0, F.coalesce("target", F.lit(0.0)) / F.col("now")).otherwise(1.0).alias("step")
            )
            at = at.join(step, name).withColumn("factor", F.col("factor") * F.col("step"))
            at = at.withColumnRenamed("step", f"step_{name}")
        at = stored(at, "cells")
        moved = at.agg(*(F.max(F.abs(F.col(f"step_{n}") - 1)) for n in wanted)).first()
        at = at.drop(*(f"step_{n}" for n in wanted))
        if max(moved) < TOLERANCE:
            break
    return at


def _rake_few(cells: DataFrame, wanted: dict[str, DataFrame], total: float) -> DataFrame:
    rows = cells.collect()  # FEW at most
    n = np.array([float(r["tokens"]) for r in rows])
    factor = np.ones(len(rows))
    sides = []
    for name, shares in wanted.items():
        target = {r[name]: r["target"] for r in shares.collect()}
        levels = sorted({r[name] for r in rows})
        place = {v: i for i, v in enumerate(levels)}
        sides.append((np.array([place[r[name]] for r in rows]), np.array([target.get(v, 0.0) for v in levels])))
    for _ in range(ROUNDS):
        worst = 0.0
        for at, target in sides:
            now = np.bincount(at, n * factor, len(target)) / total
            step = np.divide(target, now, out=np.ones(len(target)), where=now > 0)
            factor *= step[at]
            worst = max(worst, float(np.abs(step - 1).max()))
        if worst < TOLERANCE:
            break
    values = [(*r, float(f)) for r, f in zip(rows, factor)]
    return cells.sparkSession.createDataFrame(values, StructType([*cells.schema.fields, StructField("factor", DoubleType())]))


def _scale(cells: DataFrame, share: float) -> float:
    """The multiplier c for which the sum of tokens * min(1, c * factor) is the wanted share of all tokens.

    The sum grows with c; every pass tries 64 values between the bounds in one aggregate.
    """
    top, most, total = cells.agg(F.max("factor"), F.min(F.when(F.col("factor") > 0, F.col("factor"))), F.sum("tokens")).first()
    if not total or not top:
        return 0.0
    goal = share * total
    low, high = 0.0, 1.0 / most
    for _ in range(4):
        tries = [low + (high - low) * (i + 1) / 64 for i in range(64)]
        sums = cells.agg(*(F.sum(F.col("tokens") * F.least(F.lit(1.0), F.col("factor") * F.lit(c))) for c in tries)).first()
        k = next((i for i, s in enumerate(sums) if s >= goal), 63)
        low, high = (tries[k - 1] if k else low), tries[k]
    return high


def probabilities(documents: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The cells with tokens, factor and probability."""
    # names of our own, so that columns of the documents cannot clash
    cells = described(documents.select("source", "lang", "text")).select(*(_level(n).alias(n) for n in DIMENSIONS), "tokens")
    cells = stored(cells.groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens")), "cells")
    full = cells.filter("tokens > 0")
    fitted = stored(rake(full, targets(full, dict(mix.flatten))), "raked")
    c = _scale(fitted, mix.share)
    out = fitted.withColumn("probability", F.least(F.lit(1.0), F.col("factor") * F.lit(c)))
    empty = cells.filter("tokens = 0").withColumns({"factor": F.lit(0.0), "probability": F.lit(0.0)})
    return out.select(*DIMENSIONS, "tokens", "factor", "probability").unionByName(empty)


def weigh(documents: DataFrame, mix: Mix = Mix(), carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns of `carry`, n_tokens, topic, weight, probability and drawn of every row.

    Null sources and languages are a level of their own. Documents without a token have weight 0 and are not
    drawn. The draw depends on the id alone, so repeated rows are drawn together; a null id is drawn as one id.
    """
    cells = probabilities(documents, mix).select(
        *(F.col(n).alias(f"cell_{n}") for n in DIMENSIONS), F.col("factor").alias("weight"), "probability"
    )
    own = [n for n in carry if n not in ("doc_id", "topic")]
    at = documents.select("doc_id", *own, *(_level(n).alias(f"cell_{n}") for n in ("source", "lang")), topic(F.col("text")).alias("topic"), tokens(F.col("text")).alias("n_tokens"))
    at = at.withColumn("cell_topic", F.col("topic")).join(cells, [f"cell_{n}" for n in DIMENSIONS], "left")
    drawn = (F.col("n_tokens") > 0) & (uniform(F.col("doc_id"), mix.seed) < F.col("probability"))
    return at.select("doc_id", *own, "n_tokens", "topic", "weight", "probability", drawn.alias("drawn"))

"""Unique slugs.

Rows ask for a base slug in the order of their ordinal. A row gets its base, or the first free
of base-1, base-2, ... that neither a stored row nor an earlier row of the run holds.

Numbers after the base are called slots, slot 0 being the base itself. Without interference the
k-th row of a base gets its k-th free slot, which is arithmetic on running sums. Two bases
interfere only where one is the other plus a number ("x-1" and slot 1 of "x"); those contested
slots are settled first, on the contested slots alone, and then everything is assigned at once.
All steps are joins, blocked running sums and scans over blocks, so a base shared by a third of the rows is spread
over many tasks, and the number of jobs does not depend on the data.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.text import is_blank, trim
from .ordering import BLOCK, block_levels, highest, running_sum

_ENDING = "^[1-9][0-9]{0,17}$"
_NUMBERED = r"^((?s:.*))-([1-9][0-9]{0,17})$"


def _parent(slug: Column) -> Column:
    return F.when(slug.rlike(_NUMBERED), F.regexp_extract(slug, _NUMBERED, 1))


def _number(slug: Column) -> Column:
    return F.when(slug.rlike(_NUMBERED), F.regexp_extract(slug, _NUMBERED, 2).cast("bigint"))


def _stored_slots(taken: DataFrame) -> DataFrame:
    """(base, slot) pairs a stored slug blocks: its own, and its number in the base before it."""
    slug = F.col("slug")
    own = F.struct(slug.alias("base"), F.lit(0).cast("bigint").alias("slot"))
    numbered = F.struct(_parent(slug).alias("base"), _number(slug).alias("slot"))
    pairs = F.explode(F.array(own, numbered)).alias("pair")
    return taken.select(pairs).select("pair.*").where("base is not null")


def _contested(bases: DataFrame, taken: DataFrame) -> DataFrame:
    """Base slugs wanted by this run that are also a numbered slot of another wanted base."""
    children = bases.select(
        F.col("base").alias("child"), F.col("first").alias("time"), _parent(F.col("base")).alias("parent"),
        _number(F.col("base")).alias("slot"),
    ).where("parent is not null")
    parents = bases.select(F.col("base").alias("parent"))
    return children.join(parents, "parent").join(taken, F.col("child") == F.col("slug"), "left_anti")


#: Contested slots of one parent that are decided together in a task.
SCAN = 4096


def _settle(
    contested: DataFrame, rows: DataFrame, stored: DataFrame, block: int, by_time: int, by_slot: int, scan: int = SCAN
) -> DataFrame:
    """Who holds each contested slot: ``by_parent`` is true if a row of the parent base does.

    When the parent's rows reach the slot, as many of them are placed as it has free slots below. They get it if more of its
    rows than that come before the first row of the child. Free slots are all lower ones but those stored, the base
    if the parent has lost it, and contested slots that fell to children. So along the slots of a parent a counter u goes up, from 1
    if the base is lost and else from 0: a slot falls to its child, and raises u, where u <= limit = slot - stored - early rows.
    """
    none = F.lit(0).cast("bigint")
    parents = contested.select(F.col("parent").alias("base")).distinct()
    asked = contested.select(F.col("parent").alias("base"), "child", "slot", "time")
    early = asked.withColumn("spot", F.col("time")).withColumn("add", none).unionByName(
        rows.join(parents, "base", "left_semi").select(
            "base", F.col("ordinal").alias("spot"), F.lit(1).cast("bigint").alias("add")
        ),
        allowMissingColumns=True,
    )
    early = running_sum(early, ["base"], "spot", F.col("add"), "early", block, by_time).where("child is not null")
    below = asked.select("base", "child", F.col("slot").alias("spot")).withColumn("add", none).unionByName(
        stored.join(parents, "base", "left_semi").select(
            "base", F.col("slot").alias("spot"), F.lit(1).cast("bigint").alias("add")
        ),
        allowMissingColumns=True,
    )
    below = running_sum(below, ["base"], "spot", F.col("add"), "stored_below", block, by_slot).where("child is not null")
    fixed = early.select("base", "child", "slot", "early").join(below.select("child", "stored_below"), "child")
    fixed = running_sum(fixed, ["base"], "slot", F.lit(1), "place", block, by_slot)
    limits = fixed.select(
        "base", "child", "slot", F.floor((F.col("place") - 1) / scan).cast("bigint").alias("part"),
        (F.col("slot") - F.col("stored_below") - F.col("early")).alias("limit"),
    )
    marked = _bounds(limits).checkpoint()
    starts = _starts(marked)
    held = marked.join(starts, ["base", "part"]).select(
        "base", "child", "slot", (F.col("u0") > F.col("bound")).alias("kept_base"), (F.col("u1") > F.col("bound")).alias("lost_base")
    )
    return _nested(held.checkpoint())


def _bounds(limits: DataFrame) -> DataFrame:
    """Per slot the ``bound``: it falls to its child if the counter at the start of its part is not above that.

    The counter at a slot is the one at the start, u, plus the number of earlier bounds of the part not below u. That grows with
    u, so the largest u with a counter up to the limit is found by bisection.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, before = None, []
        for batch in batches:
            bounds = []
            for base, part, limit in zip(*(batch.column(n).to_pylist() for n in ("base", "part", "limit"))):
                if (base, part) != at:
                    at, before = (base, part), []
                low, high = limit - len(before), limit
                while low < high:
                    u = (low + high + 1) // 2
                    if u + len(before) - bisect_left(before, u) <= limit:
                        low = u
                    else:
                        high = u - 1
                bounds.append(low)
                insort(before, low)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(bounds, pa.int64())], names=[*batch.schema.names, "bound"])

    ordered = limits.repartition("base", "part").sortWithinPartitions("base", "part", "slot")
    return ordered.mapInArrow(run, T.StructType([*limits.schema.fields, T.StructField("bound", T.LongType())]))


def _starts(marked: DataFrame) -> DataFrame:
    """Per base and part the counter at its start: u0 if the base is kept, u1 if it is lost.

    Only bases of several parts need a scan over them; it holds the bounds of one part at a time.
    """
    parts = marked.groupBy("base").agg(F.max("part").alias("last"))
    single = parts.where("last = 0").select("base", F.col("last").alias("part"), F.lit(0).cast("bigint").alias("u0"), F.lit(1).cast("bigint").alias("u1"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, part, u, held = None, None, (0, 1), []
        for batch in batches:
            out = []
            for b, p, bound in zip(*(batch.column(n).to_pylist() for n in ("base", "part", "bound"))):
                if (b, p) != (base, part):
                    u = tuple(x + sum(v >= x for v in held) for x in u) if b == base else (0, 1)
                    base, part, held = b, p, []
                    out.append((b, p, *u))
                held.append(bound)
            cols = list(zip(*out)) if out else [()] * 4
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["base", "part", "u0", "u1"])

    several = marked.join(parts.where("last > 0").select("base"), "base", "left_semi").select("base", "part", "slot", "bound")
    scanned = several.repartition("base").sortWithinPartitions("base", "part", "slot").mapInArrow(run, "base string, part bigint, u0 bigint, u1 bigint")
    return single.unionByName(scanned)


def _nested(held: DataFrame) -> DataFrame:
    """``by_parent`` of every contested slot, from what it is if its parent keeps, or has lost, its own base.

    Whether the parent has lost it is the same question one number further up. The bases above a slug are its
    beginnings, as many as it ends in numbers, so each slug looks up its own line.
    """
    parts = F.split("child", "-")
    ends = F.aggregate(
        F.reverse(parts), F.struct(F.lit(0).alias("n"), F.lit(True).alias("on")),
        lambda s, x: F.struct((s["n"] + F.when(s["on"] & x.rlike(_ENDING), 1).otherwise(0)).alias("n"), (s["on"] & x.rlike(_ENDING)).alias("on")),
        lambda s: s["n"],
    )
    line = held.select("base", "child", "slot", parts.alias("parts"), ends.alias("depth"))
    line = line.select("*", F.explode(F.sequence(F.lit(0), F.greatest(F.col("depth") - 1, F.lit(0)))).alias("up"))
    line = line.withColumn("above", F.array_join(F.slice("parts", F.lit(1), F.size("parts") - F.col("up")), "-"))
    rule = held.select(F.col("child").alias("above"), "kept_base", "lost_base")
    met = line.join(rule, "above").groupBy("base", "child", "slot", "depth").agg(
        F.map_from_entries(F.collect_list(F.struct("up", F.struct("kept_base", "lost_base")))).alias("rules")
    )
    lost = F.aggregate(
        F.reverse(F.sequence(F.lit(0), F.greatest(F.col("depth") - 1, F.lit(0)))), F.lit(False),
        lambda lost, up: F.coalesce(F.when(lost, F.try_element_at("rules", up)["lost_base"]).otherwise(F.try_element_at("rules", up)["kept_base"]), F.lit(False)),
    )
    return met.select("base", "child", "slot", lost.alias("by_parent"))


def unique_slugs(
    changes: DataFrame,
    stored_slugs: DataFrame,
    keys: Sequence[str],
    wanted: str = "seo_slug",
    ordinal: str = "ordinal",
    into: str = "seo_slug",
    block: int = BLOCK,
    scan: int = SCAN,
) -> DataFrame:
    """Keys and assigned slug for the rows of a run that need one.

    ``changes`` holds one row per key, only rows whose stored slug is blank, with a unique
    integer ordinal that is not negative. ``stored_slugs`` is the slug column of the whole target.
    Rows that want a blank slug get none and are not returned.
    """
    slug_column = stored_slugs.columns[0]
    rows = changes.select(
        *keys, trim(F.col(wanted)).alias("base"), F.col(ordinal).cast("bigint").alias("ordinal")
    ).where(~is_blank(F.col("base")))
    # every step below reads these narrow rows, so what they are made from runs once
    rows = rows.checkpoint()
    taken = stored_slugs.select(F.col(slug_column).alias("slug")).where("slug is not null").distinct()
    bases = rows.groupBy("base").agg(F.min("ordinal").alias("first"), F.count("*").alias("wanting")).checkpoint()
    stored = _stored_slots(taken).join(bases.select("base"), "base", "left_semi").checkpoint()
    blocked = stored
    contested = _contested(bases, taken).checkpoint()
    top_slot = max(highest(stored, F.col("slot")), highest(contested, F.col("slot")))
    by_time = block_levels(highest(rows, F.col("ordinal")), block)
    by_slot = block_levels(top_slot, block)
    if not contested.isEmpty():
        settled = _settle(contested, rows, stored, block, by_time, by_slot, scan)
        held_by_child = settled.where("not by_parent").select("base", "slot")
        lost_base = settled.where("by_parent").select(
            F.col("child").alias("base"), F.lit(0).cast("bigint").alias("slot")
        )
        blocked = stored.unionByName(held_by_child).unionByName(lost_base)
    numbered = running_sum(rows, ["base"], "ordinal", F.lit(1), "nth", block, by_time)
    nth_blocked = running_sum(blocked, ["base"], "slot", F.lit(1), "nth", block, by_slot)
    free_before = F.col("slot") - F.col("nth") + 1
    jumps = nth_blocked.groupBy("base", free_before.alias("free")).agg(F.count("*").alias("add"))
    # a block behind the last row of its base is never reached
    jumps = jumps.join(bases, "base").where("free < wanting")
    line = numbered.withColumn("spot", (F.col("nth") - 1) * 2 + 1).withColumn("add", F.lit(0).cast("bigint"))
    line = line.unionByName(
        jumps.select("base", (F.col("free") * 2).alias("spot"), "add"), allowMissingColumns=True
    )
    by_spot = block_levels(2 * highest(bases, F.col("wanting")), block)
    placed = running_sum(line, ["base"], "spot", F.col("add"), "passed", block, by_spot).where("ordinal is not null")
    slot = F.col("nth") - 1 + F.col("passed")
    slug = F.when(slot == 0, F.col("base")).otherwise(F.concat_ws("-", F.col("base"), slot.cast("string")))
    return placed.select(*keys, slug.alias(into))

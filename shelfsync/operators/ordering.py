"""Order-dependent operators: running sums, numbering, paging, duplicates within a run.

No operator here sorts an unbounded group in one task. Keep-the-best rules are written as
``row_number() <= n`` so that Spark cuts each group to n rows before the shuffle; running sums
and numbering work on blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from .filters import sort_columns

BLOCK = 1 << 20


def block_levels(highest: int | None, block: int = BLOCK) -> int:
    """Levels that keep every task within ``block`` positions; the third is the last."""
    highest = highest or 0
    return 0 if highest < block else 1 if highest < block * block else 2


def highest(df: DataFrame, *columns: Column) -> int:
    """Largest value over some columns, one number."""
    return df.agg(F.greatest(*[F.coalesce(F.max(c), F.lit(0)) for c in (*columns, F.lit(0))])).first()[0]


def running_sum(
    df: DataFrame,
    group: Sequence[str],
    position: str,
    value: Column,
    into: str,
    block: int = BLOCK,
    levels: int = 2,
) -> DataFrame:
    """Running sum (inclusive) of ``value`` per group in the order of an integer position.

    Positions are unique within a group and not negative. The group is cut into blocks of
    ``block`` positions, so a task sorts at most ``block`` rows however large the group is.
    The sums of the blocks are added up the same way, one level higher. ``block_levels`` tells
    how many levels a highest position needs; 0 is a plain window.
    """
    rows = df.withColumn("__value", value.cast("bigint"))
    if levels == 0:
        order = Window.partitionBy(*group).orderBy(position)
        return rows.withColumn(into, F.sum("__value").over(order)).drop("__value")
    part = f"__block{levels}"
    rows = rows.withColumn(part, F.floor(F.col(position) / F.lit(block)))
    totals = rows.groupBy(*group, part).agg(F.sum("__value").alias("__total"))
    reached = running_sum(totals, group, part, F.col("__total"), "__reached", block, levels - 1)
    before = reached.select(*group, part, (F.col("__reached") - F.col("__total")).alias("__before"))
    order = Window.partitionBy(*group, part).orderBy(position)
    return (
        rows.join(before, [*group, part])
        .withColumn(into, F.col("__before") + F.sum("__value").over(order))
        .drop(part, "__value", "__before")
    )


def global_number(df: DataFrame, order: Sequence[str], into: str, start: int = 1) -> DataFrame:
    """Dense numbers over the whole table in the given order, without a single-task window.

    The rows are range-sorted once and checkpointed, so that both the row counts of the
    partitions and the numbering read the same fixed partitions. The order should end with a
    unique column: it makes the numbers repeatable and lets a hot value be split.
    """
    fixed = df.orderBy(*sort_columns(order)).checkpoint()
    spot = fixed.withColumn("__spot", F.monotonically_increasing_id())
    part = F.shiftright("__spot", 33)
    sizes = spot.groupBy(part.alias("__part")).agg(F.count("*").alias("__size"))
    # one row per partition of the sort
    ahead = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__part", F.coalesce(F.sum("__size").over(ahead), F.lit(0)).alias("__ahead"))
    inside = F.col("__spot").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        spot.withColumn("__part", part)
        .join(F.broadcast(starts), "__part")
        .withColumn(into, F.col("__ahead") + inside + F.lit(start))
        .drop("__spot", "__part", "__ahead")
    )


def number_narrow(df: DataFrame, order: Sequence[str], into: str, start: int = 1) -> DataFrame:
    """Numbers as ``global_number`` gives them, for wide rows: only the order columns are sorted and checkpointed.

    Distinct values of the order columns are numbered, as many numbers apart as there are rows with them; the rows
    then look theirs up. Rows that are equal in the order get consecutive numbers in the order of their columns.
    """
    columns = [c.split()[0] for c in order]
    sizes = df.groupBy(*columns).agg(F.count("*").alias("__rows"))
    fixed = sizes.orderBy(*sort_columns(order)).checkpoint()
    part = F.shiftright(F.monotonically_increasing_id(), 33)
    fixed = fixed.withColumn("__part", part)
    totals = fixed.groupBy("__part").agg(F.sum("__rows").alias("__total"))
    # one row per partition of the sort
    ahead = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("__part", F.coalesce(F.sum("__total").over(ahead), F.lit(0)).alias("__ahead"))
    inside = Window.partitionBy("__part").orderBy(*sort_columns(order)).rowsBetween(Window.unboundedPreceding, -1)
    first = fixed.withColumn("__inside", F.coalesce(F.sum("__rows").over(inside), F.lit(0))).join(F.broadcast(starts), "__part")
    first = first.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(columns)], "__rows", (F.col("__ahead") + F.col("__inside") + F.lit(start)).alias("__first"))
    on = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"__k{i}")) for i, c in enumerate(columns)])
    met = df.join(first, on)
    single = met.where("__rows = 1").withColumn("__place", F.lit(0))
    several = global_number(met.where("__rows > 1"), ["__first", *total_order(df, df.columns)], "__number")
    heads = several.groupBy(F.col("__first").alias("__of")).agg(F.min("__number").alias("__head"))
    several = several.join(heads, F.col("__first") == F.col("__of")).withColumn("__place", F.col("__number") - F.col("__head"))
    found = (F.col("__first") + F.col("__place")).cast("bigint").alias(into)
    return single.select(*df.columns, found).unionByName(several.select(*df.columns, found))


def assign_ids(df: DataFrame, order: Sequence[str], max_id: int = 0, into: str = "id") -> DataFrame:
    """Surrogate ids above ``max_id`` in insertion order."""
    return global_number(df.drop(into), order, into, max_id + 1)


# Rows up to the end of a page that are gathered at once; pages further in are cut from a global sort.
PAGE_REACH = 1 << 20


def page_by_row_number(
    df: DataFrame, order: Sequence[str], offset: int, limit: int, into: str = "row_no", reach: int = PAGE_REACH
) -> DataFrame:
    """Rows ``offset + 1`` to ``offset + limit`` with their number.

    Near the start only the rows up to the end of the page are gathered, no more per task. Ties in the order are
    broken by the other columns, so that pages neither repeat nor leave out rows, whichever way they are found.
    """
    order = _total(df, order)
    if offset + limit > reach:
        return global_number(df, order, into).where(F.col(into).between(offset + 1, offset + limit))
    columns = sort_columns(order)
    head = df.orderBy(*columns).limit(offset + limit)
    number = F.row_number().over(Window.orderBy(*columns)).cast("bigint")
    return head.withColumn(into, number).where(F.col(into) > offset)


def page(df: DataFrame, order: Sequence[str], number: int, size: int, reach: int = PAGE_REACH) -> DataFrame:
    """One page of a table; a page beyond the end shows the last one.

    A page near the end is found from the end, with the order reversed. Ties are broken by the other columns.
    """
    order = _total(df, order)
    total = df.count()
    pages = max(1, -(-total // size))
    offset = (min(max(1, number), pages) - 1) * size
    if offset + size <= reach:
        return df.orderBy(*sort_columns(order)).offset(offset).limit(size)
    if total - offset <= reach:
        return df.orderBy(*_reverse(order)).limit(total - offset).orderBy(*sort_columns(order)).limit(size)
    return page_by_row_number(df, order, offset, size, "__no", reach).orderBy("__no").drop("__no")


def _total(df: DataFrame, order: Sequence[str]) -> list[str]:
    named = {entry.split()[0] for entry in order}
    return [*order, *[c for c in total_order(df, df.columns) if c not in named]]


# Rows of a group that one task sorts, about, where groups are cut in parts first.
PART_ROWS = 1 << 20


def keep_latest(df: DataFrame, per: Sequence[str], order: Sequence[str], n: int, spread: Sequence[str] = ()) -> DataFrame:
    """The first n rows of each group in the given order.

    Spark cuts groups before the shuffle for small n. For a large n pass ``spread``, columns
    that differ within a group: the cut is then made in parts of the group first, as many as
    the table could need if all of it were one group.
    """
    rows = df
    if spread:
        pieces = max(64, df.count() // PART_ROWS)
        parts = Window.partitionBy(*per, "__part").orderBy(*sort_columns(order))
        rows = (
            rows.withColumn("__part", F.pmod(F.xxhash64(*spread), F.lit(pieces)))
            .withColumn("__rank", F.row_number().over(parts))
            .where(F.col("__rank") <= n)
            .drop("__part", "__rank")
        )
    whole = Window.partitionBy(*per).orderBy(*sort_columns(order))
    return rows.withColumn("__rank", F.row_number().over(whole)).where(F.col("__rank") <= n).drop("__rank")


def order_key(df: DataFrame, order: Sequence[str]) -> list[Column]:
    """Columns whose smallest struct is the first row in the order; none if the order has a descending column that is no number."""
    key: list[Column] = []
    for entry in order:
        name, _, direction = entry.strip().partition(" ")
        if direction.strip().lower() != "desc":
            key.append(F.col(name))
        elif isinstance(df.schema[name].dataType, T.NumericType):
            key += [F.col(name).isNull(), -F.col(name)]  # nulls come last
        else:
            return []
    return key


def first_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the earliest in the run."""
    return keep_latest(df, keys, order, 1)


def _reverse(order: Sequence[str]) -> list[Column]:
    flipped = []
    for entry in order:
        name, _, direction = entry.strip().partition(" ")
        c = F.col(name)
        flipped.append(c.asc_nulls_first() if direction.strip().lower() == "desc" else c.desc_nulls_last())
    return flipped


def fold_duplicates(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], fields: Sequence[str], into: str = "previous",
    spoilt: str | None = None,
) -> DataFrame:
    """The last row per key, with the named fields of the row before it as a struct.

    Two rows per key and task are shuffled at most. Rows marked by the boolean column ``spoilt`` are not
    looked at; one of them stands for a key that has no other.
    """
    latest = Window.partitionBy(*keys).orderBy(*([F.col(spoilt)] if spoilt else []), *_reverse(order))
    row = F.struct(*fields)
    before = F.lead(F.when(~F.col(spoilt), row) if spoilt else row).over(latest)
    return (
        df.withColumn("__rank", F.row_number().over(latest))
        .where(F.col("__rank") <= 2)
        .withColumn(into, before)
        .where(F.col("__rank") == 1)
        .drop("__rank")
    )


# Rows of a key above which its rows are sorted over all tasks instead of in one.
HOT_ROWS = 1 << 16


def neighbour_steps(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], fields: Sequence[str], changed: Callable[[str, str], Column],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Per key: taken (rows), moved (rows that differ from the one before them) and head (the fields of the first row).

    ``changed`` tests two structs of the fields, given by name. The rows of a key are sorted in the task of the key. Only those
    of keys with more than ``hot_rows`` rows are sorted over all tasks, so that a hot key falls into many ranges; neighbours
    are compared within a range, then the ends of the ranges with each other, one row for each key and range.
    """
    by = [c.split()[0] for c in order]
    hot = df.groupBy(*keys).agg(F.count("*").alias("__n")).where(F.col("__n") > hot_rows).select(*keys).checkpoint()
    df = df.select(*dict.fromkeys([*keys, *by]), F.struct(*[F.col(c) for c in fields or keys]).alias("__row"))
    if hot.isEmpty():
        return _steps_in_tasks(df, keys, order, changed)
    rest = _steps_in_tasks(df.join(hot, list(keys), "left_anti"), keys, order, changed)
    return rest.unionByName(_steps_in_ranges(df.join(hot, list(keys), "left_semi"), keys, order, changed))


def _steps_in_tasks(df: DataFrame, keys: Sequence[str], order: Sequence[str], changed: Callable[[str, str], Column]) -> DataFrame:
    inside = Window.partitionBy(*keys).orderBy(*sort_columns(order))
    rows = df.withColumn("__before", F.lag("__row").over(inside))
    return rows.groupBy(*keys).agg(
        F.count("*").alias("taken"),
        F.count_if(F.col("__before").isNotNull() & changed("__row", "__before")).alias("moved"),
        F.first(F.when(F.col("__before").isNull(), F.col("__row")), ignorenulls=True).alias("head"),
    )


def _steps_in_ranges(df: DataFrame, keys: Sequence[str], order: Sequence[str], changed: Callable[[str, str], Column]) -> DataFrame:
    many = df.orderBy(*keys, *sort_columns(order)).checkpoint()
    many = many.withColumn("__part", F.shiftright(F.monotonically_increasing_id(), 33))
    inside = Window.partitionBy("__part", *keys).orderBy(*sort_columns(order))
    many = many.withColumn("__before", F.lag("__row").over(inside)).withColumn("__after", F.lead("__row").over(inside))
    ranges = many.groupBy("__part", *keys).agg(
        F.count("*").alias("taken"),
        F.count_if(F.col("__before").isNotNull() & changed("__row", "__before")).alias("moved"),
        F.first(F.when(F.col("__before").isNull(), F.col("__row")), ignorenulls=True).alias("head"),
        F.first(F.when(F.col("__after").isNull(), F.col("__row")), ignorenulls=True).alias("tail"),
    )
    ranges = ranges.withColumn("__before", F.lag("tail").over(Window.partitionBy(*keys).orderBy("__part")))
    step = F.when(F.col("__before").isNotNull() & changed("head", "__before"), 1).otherwise(0)
    return ranges.groupBy(*keys).agg(
        F.sum("taken").alias("taken"), F.sum(F.col("moved") + step).alias("moved"), F.min_by("head", "__part").alias("head")
    )


def total_order(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Those of the columns that can be sorted by; they make an order where none is declared."""
    return [c for c in columns if not isinstance(df.schema[c].dataType, (T.MapType, T.VariantType))]


def last_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key, the last in the given order, or else in the order of the other columns."""
    by = order or total_order(df, [c for c in df.columns if c not in keys])
    return keep_latest(df, keys, _flipped(by), 1) if by else df.dropDuplicates(list(keys))


def _flipped(order: Sequence[str]) -> list[str]:
    return [c[:-5] if c.lower().endswith(" desc") else f"{c} desc" for c in order]


def natural_key(name: Column) -> Column:
    """Sort key in which digit runs count as numbers and case is ignored."""
    pieces = F.split(F.lower(name), r"(?<=\D)(?=\d)|(?<=\d)(?=\D)")
    digits = lambda p: F.regexp_replace(p, "^0+(?=.)", "")
    keyed = F.transform(
        pieces,
        lambda p: F.when(
            p.rlike(r"^\d+$"), F.concat(F.lpad(F.length(digits(p)).cast("string"), 6, "0"), digits(p))
        ).otherwise(p),
    )
    return F.array_join(keyed, "")

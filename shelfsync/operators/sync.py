"""The sync of one entity, and runs over several."""

from __future__ import annotations

from collections import ChainMap, Counter
from collections.abc import Callable, Mapping, Sequence
from contextlib import nullcontext
from dataclasses import dataclass, field, replace
from functools import reduce
from operator import and_, or_
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ..functions.compare import canonical, delta_changed
from ..functions.text import is_blank
from ..sources.run_cache import RunCache
from .delta import INSERT, UNCHANGED, UPDATE, action, attach_existing, differs, flag_values, set_where_different
from .mapping import as_column, has_keys
from .merge import replace_merge
from .ordering import assign_ids, first_wins, fold_duplicates, neighbour_steps, total_order
from .orphans import OrphanPolicy
from .rejects import fallible, listed, refused
from .slugs import unique_slugs

ORPHAN, KEPT = "orphan", "kept"


@dataclass(frozen=True)
class EntitySpec:
    """One mapping job.

    ``columns`` maps target columns to Columns over the source rows. ``prepare`` may then drop
    rows or resolve keys, ``enrich`` looks up other columns; steps that need keys only skip it.
    ``order`` makes the run order of equal keys
    explicit; ``slug`` names a column to keep unique, with a unique integer ``ordinal``.
    ``surrogate`` names an id column that new rows fill in the order of the run.
    """

    name: str
    source: str
    target: str
    columns: Mapping[str, Any]
    keys: Sequence[str]
    delta: Sequence[str] = ()
    on_insert: Mapping[str, Any] = field(default_factory=dict)
    on_changed: Mapping[str, Any] = field(default_factory=dict)
    on_unchanged: Mapping[str, Any] = field(default_factory=dict)
    orphans: Sequence[OrphanPolicy] = ()
    order: Sequence[str] = ()
    prepare: Callable[[DataFrame, Mapping[str, DataFrame]], DataFrame] | None = None
    enrich: Callable[[DataFrame, Mapping[str, DataFrame]], DataFrame] | None = None
    slug: str | None = None
    ordinal: str | None = None
    surrogate: str | None = None


def map_entity(
    spec: EntitySpec, source: DataFrame, tables: Mapping[str, DataFrame], enriched: bool = True,
    watch: Watch | None = None,
) -> DataFrame:
    """Source rows as target rows, with the order columns carried along as ``__o0``, ..."""
    order = [F.col(c.split()[0]).alias(f"__o{i}") for i, c in enumerate(spec.order)]
    ordinal = [F.col(spec.ordinal).alias("__ordinal")] if spec.ordinal else []
    rows = source.select(*[as_column(v).alias(c) for c, v in spec.columns.items()], *order, *ordinal)
    if watch:
        rows = rows.observe(watch.source, F.count("*").alias("processed"))
    rows = spec.prepare(rows, tables) if spec.prepare else rows
    return spec.enrich(rows, tables) if spec.enrich and enriched else rows


def has_input(spec: EntitySpec, source: DataFrame) -> bool:
    """Whether any source row has its keys; reads key columns only, up to the first hit."""
    keys = [k for k in spec.keys if k in spec.columns]
    return not source.select(*[as_column(spec.columns[k]).alias(k) for k in keys]).where(has_keys(keys)).isEmpty()


def _run_order(spec: EntitySpec) -> list[str]:
    return [f"__o{i}" + c[len(c.split()[0]):] for i, c in enumerate(spec.order)]


class Watch:
    """Counts taken while a run is written: source rows, rows with their keys, and rows that do not fit."""

    def __init__(self) -> None:
        self.source, self.kept = Observation(), Observation()

    def fit(self) -> int:
        """Rows that can be written."""
        return self.kept.get["kept"] - self.kept.get["errors"]

    def stats(self) -> dict[str, int]:
        processed, kept = self.source.get["processed"], self.kept.get
        return {"processed": processed, "skipped": max(0, processed - kept["kept"]), "errors": kept["errors"]}


def classify_entity(
    spec: EntitySpec, source: DataFrame, target: DataFrame, tables: Mapping[str, DataFrame] | None = None,
    watch: Watch | None = None,
) -> DataFrame:
    """New content of the target plus the column ``action``, in one pass.

    The rows of both sides meet once, in a full outer join on the merge key: it finds the
    stored row of each change, the orphans and the rows to keep. Repeated keys are folded on
    the same partitioning before it, in the declared order or else that of their values. The
    folded frame serves both the delta test and the write. A row with a value that does not fit is left out.
    """
    if _guarded(spec) and not has_input(spec, source):
        raise ValueError(REFUSED.format(spec.name))

    def keyed() -> DataFrame:
        return typed(spec, map_entity(spec, source, tables or {}, enriched=False), target)

    return _classify(spec, _mapped(spec, source, target, tables, watch), target, target, keyed)


REFUSED = "{}: no rows to process, refusing to disable the whole target"


def _guarded(spec: EntitySpec) -> bool:
    return any(not policy.allow_empty for policy in spec.orphans)


def _mapped(
    spec: EntitySpec, source: DataFrame, target: DataFrame, tables: Mapping[str, DataFrame] | None, watch: Watch | None
) -> DataFrame:
    rows = typed(spec, map_entity(spec, source, tables or {}, watch=watch), target)
    return rows.observe(watch.kept, F.count("*").alias("kept"), F.count_if("__bad").alias("errors")) if watch else rows


def _classify(
    spec: EntitySpec, mapped: DataFrame, target: DataFrame, whole: DataFrame, keyed: Callable[[], DataFrame]
) -> DataFrame:
    """``target`` holds the stored rows of all keys of the run, ``whole`` the whole table; ``keyed`` gives keys and order only."""
    keys, mapped = list(spec.keys), mapped.drop("__rejects")
    payload = [c for c in mapped.columns if not c.startswith("__")]
    fields = [c for c in spec.delta if c in payload] or keys
    order = _run_order(spec) or total_order(mapped, payload)
    run = mapped
    mapped = fold_duplicates(mapped, keys, order, fields, "__previous", "__bad")
    if set(spec.on_changed) - set(spec.on_unchanged) and spec.delta:
        mapped = mapped.join(_history(run, keys, [c for c in spec.delta if c in payload]), keys, "left")
    else:
        mapped = mapped.withColumn("__moved", F.lit(False))
    if spec.surrogate:
        ids = _new_ids(spec, keyed().where("NOT __bad"), target, whole)
        mapped = mapped.join(ids, keys, "left")
    joined = attach_existing(mapped, target, keys, "full_outer")
    seen, stored = F.col("new.__new").isNotNull(), F.col("old.__old").isNotNull()
    incoming = seen & ~F.coalesce(F.col("new.__bad"), F.lit(False))
    joined = joined.where(incoming | stored)
    repeated = F.col("new.__previous").isNotNull()
    previous = [
        (f"new.`{c}`", f"new.__previous.`{c}`", mapped.schema[c].dataType, mapped.schema[c].dataType)
        for c in spec.delta
        if c in payload
    ]
    # tested once per row, and read by every flag column below
    joined = joined.withColumn("__changed", differs(mapped, target, spec.delta))
    step = F.when(repeated, delta_changed(previous)).otherwise(F.col("__changed"))
    joined = joined.withColumn("__step", F.when(incoming, action(stored | repeated, step)).otherwise(KEPT))

    values: dict[str, Column] = {c: F.col(f"old.{c}") for c in target.columns}
    for c in payload:
        if spec.slug == c:
            continue
        values[c] = F.when(incoming, F.col(f"new.{c}")).otherwise(values[c]) if c in values else F.col(f"new.{c}")
    if spec.surrogate:
        values[spec.surrogate] = F.coalesce(F.col(f"old.{spec.surrogate}"), F.col("new.__id"))
    # what earlier rows of the run have left behind
    moved = F.coalesce(F.col("new.__moved"), F.lit(False))
    values = flag_values(values, incoming & repeated & ~stored, spec.on_insert)
    values = flag_values(values, incoming & repeated & (moved | (stored & F.col("__changed"))), spec.on_changed)
    for name, flags in ((INSERT, spec.on_insert), (UPDATE, spec.on_changed), (UNCHANGED, spec.on_unchanged)):
        values = flag_values(values, F.col("__step") == name, flags)

    extra = [F.col(f"new.{spec.slug}").alias("__wanted"), F.col("new.__ordinal").alias("__ordinal")] if spec.slug else []
    result = joined.select(
        *[values[c].cast(target.schema[c].dataType).alias(c) for c in target.columns],
        F.col("__step").alias("action"),
        seen.alias("__seen"),
        (seen & ~incoming).alias("__spoilt"),
        *extra,
    )
    if spec.slug:
        result = _with_slugs(spec, result, whole)
    return _with_orphans(spec, result, target, run)


def typed(spec: EntitySpec, rows: DataFrame, target: DataFrame) -> DataFrame:
    """Rows with their keys, in the types of the target. ``__bad`` marks rows with a value that does not fit, ``__rejects`` lists those.

    Such a row is not written and counts as an error; its key still counts as seen.
    """
    kinds = {f.name: f.dataType for f in target.schema.fields if f.name in rows.columns and f.name != spec.slug}
    kinds = {c: k for c, k in kinds.items() if rows.schema[c].dataType != k}
    risky = {c: k for c, k in kinds.items() if fallible(rows.schema[c].dataType, k)}
    spoilt = [F.col(c).isNotNull() & F.col(c).try_cast(k).isNull() for c, k in risky.items()]
    bad = reduce(or_, spoilt) if spoilt else F.lit(False)
    # a key that does not fit cannot be told apart from others and stays out altogether, but is counted
    return rows.where(has_keys(spec.keys)).select(
        *[F.col(c).try_cast(kinds[c]).alias(c) if c in kinds else F.col(c) for c in rows.columns],
        bad.alias("__bad"), F.when(bad, refused(risky)).alias("__rejects"),
    )


def _history(run: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Keys whose rows differ among themselves within the run: keys and ``__moved``.

    The smallest and the largest canonical value differ exactly then, so no group is sorted or gathered. Values are
    compared for keys that occur more than once only.
    """
    value = F.struct(*[F.expr(canonical(f"`{c}`", run.schema[c].dataType)).alias(c) for c in fields])
    fit = run.where("NOT __bad")
    often = fit.groupBy(*keys).agg(F.count("*").alias("__n")).where("__n > 1").select(*keys)
    spread = fit.join(often, list(keys), "left_semi").groupBy(*keys).agg(F.min(value).alias("__low"), F.max(value).alias("__high"))
    return spread.where("__low <> __high").select(*keys, F.lit(True).alias("__moved"))


def _new_ids(spec: EntitySpec, mapped: DataFrame, target: DataFrame, whole: DataFrame) -> DataFrame:
    """Ids for the keys the target does not have, above its highest, by first row in the run.

    Only keys and order columns take part, so the payload is not shuffled for it.
    """
    keys, order = list(spec.keys), _run_order(spec)
    rows = mapped.select(*keys, *[c.split()[0] for c in order])
    rows = first_wins(rows, keys, order) if order else rows.dropDuplicates(keys)
    fresh = rows.join(target.select(*keys), keys, "left_anti")
    top = whole.agg(F.max(spec.surrogate)).first()[0] or 0
    return assign_ids(fresh, [*order, *keys], top, "__id").select(*keys, "__id")


def _with_slugs(spec: EntitySpec, rows: DataFrame, target: DataFrame) -> DataFrame:
    """A stored slug stays; the other rows of the run get a unique one."""
    keys = list(spec.keys)
    asking = rows.where((F.col("action") != KEPT) & is_blank(F.col(spec.slug)))
    given = unique_slugs(asking, target.select(spec.slug), keys, "__wanted", "__ordinal", "__slug")
    slug = F.coalesce(F.col("__slug"), F.col(spec.slug))
    return rows.join(given, keys, "left").select(
        *[slug.alias(c) if c == spec.slug else F.col(c) for c in target.columns], "action", "__seen", "__spoilt"
    )


def _with_orphans(spec: EntitySpec, rows: DataFrame, target: DataFrame, run: DataFrame) -> DataFrame:
    """Rows of the target no change accounts for, updated by the policies, each over all stored rows.

    A policy that matches by the merge key needs no further join. For another key the keys of the run are
    joined once for each policy, before any policy acts, so the plan grows with their number only. A stored row
    whose change was in error is known to the run and no orphan by any key.
    """
    other = [(i, p) for i, p in enumerate(spec.orphans) if list(p.match_key) != list(spec.keys)]
    for i, policy in other:
        source = run if all(k in run.columns for k in policy.match_key) else rows.where("__seen")
        names = {k: f"__match_{k}" for k in policy.match_key}
        found = source.select(*[F.col(k).alias(n) for k, n in names.items()]).distinct().withColumn(f"__seen{i}", F.lit(True))
        on = reduce(and_, [F.col(k) == F.col(n) for k, n in names.items()])
        rows = rows.join(found, on, "left").drop(*names.values())
    for i, policy in enumerate(spec.orphans):
        by_other = any(i == j for j, _ in other)
        unseen = F.col(f"__seen{i}").isNull() if by_other else ~F.col("__seen")
        rows = set_where_different(rows, unseen & ~F.col("__spoilt") & policy.candidates(), policy.values(), "__hit")
        rows = rows.withColumn("action", F.when(F.col("__hit"), ORPHAN).otherwise(F.col("action"))).drop("__hit")
    return rows.select(*target.columns, "action")


def sync_stats(classified: DataFrame) -> DataFrame:
    """One row: inserted, updated, unchanged and orphaned rows, each key by the last row of the run that has it."""
    of = lambda name: F.count_if(F.col("action") == name)
    return classified.agg(
        of(INSERT).alias("inserted"), of(UPDATE).alias("updated"), of(UNCHANGED).alias("unchanged"), of(ORPHAN).alias("orphans")
    )


def key_steps(spec: EntitySpec, mapped: DataFrame, target: DataFrame) -> DataFrame:
    """Per key of the run: known (stored before), taken (rows that fit), moved (of them, those that change what the row
    before has left, the first being compared with the stored row), and changed (last row against the stored one).

    ``mapped`` are the rows as ``typed`` makes them. The rows of one key are not gathered: neighbours are compared within
    ranges of the run, and the ends of the ranges with each other.
    """
    keys = list(spec.keys)
    rows = mapped.where("NOT __bad")
    payload = [c for c in rows.columns if not c.startswith("__")]
    fields = [c for c in spec.delta if c in payload]
    order = _run_order(spec) or total_order(rows, payload)
    kinds = {c: rows.schema[c].dataType for c in fields}
    steps = neighbour_steps(
        rows, keys, order, fields,
        lambda now, before: delta_changed([(f"{now}.`{c}`", f"{before}.`{c}`", k, k) for c, k in kinds.items()]),
    )
    ends = steps.select(*keys, "taken", "moved", *[F.col(f"head.{c}").alias(c) for c in fields if c not in keys])
    first = attach_existing(ends, target, keys)
    head = first.withColumn("__first", differs(ends, target, fields))
    known = F.coalesce(F.col("old.__old"), F.lit(False))
    moved = F.col("new.moved") + F.when(known & F.col("__first"), 1).otherwise(0)
    return head.select(*[F.col(f"new.`{k}`").alias(k) for k in keys], known.alias("known"), F.col("new.taken").alias("taken"), moved.alias("moved"))


def row_stats(steps: DataFrame) -> DataFrame:
    """One row of counts. By source row: inserted, updated and unchanged, which with the skipped ones and errors make up
    all that was processed; a key that is new counts as inserted once. By target row: new_rows and known_rows."""
    fresh = F.when(F.col("known"), 0).otherwise(1)
    whole = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return steps.agg(
        whole(fresh).alias("inserted"), whole(F.col("moved")).alias("updated"),
        whole(F.col("taken") - F.col("moved") - fresh).alias("unchanged"),
        whole(fresh).alias("new_rows"), whole(1 - fresh).alias("known_rows"),
    )


def intake_stats(
    spec: EntitySpec, source: DataFrame, tables: Mapping[str, DataFrame] | None = None, target: DataFrame | None = None
) -> DataFrame:
    """One row: source rows processed, those skipped (without a key, or dropped on the way), and those that do not
    fit the types of ``target``."""
    total = source.agg(F.count("*").alias("processed"))
    rows = map_entity(spec, source, tables or {}, enriched=target is not None)
    rows = typed(spec, rows, target) if target is not None else rows.where(has_keys(spec.keys)).withColumn("__bad", F.lit(False))
    kept = rows.agg(F.count("*").alias("kept"), F.count_if("__bad").alias("errors"))
    one = F.lit(1).alias("__one")  # one row meets one row
    both = total.select("*", one).join(kept.select("*", one), "__one")
    return both.select("processed", F.greatest(F.lit(0).cast("bigint"), F.col("processed") - F.col("kept")).alias("skipped"), "errors")


# Entities that go first in a run; the rest follows by name.
FIRST_ENTITIES = ("category", "article")


def run_order(names: Sequence[str]) -> list[str]:
    rank = {name: i for i, name in enumerate(FIRST_ENTITIES)}
    return sorted(names, key=lambda n: (rank.get(n, len(rank)), n))


STATS_SCHEMA = (
    "entity string, processed bigint, skipped bigint, errors bigint, inserted bigint, updated bigint, "
    "unchanged bigint, orphans bigint, error string"
)


#: Added files of a bucket beyond which a blind upsert merges them.
MOST_DELTAS = 8


def needs_existing(spec: EntitySpec) -> bool:
    """Whether anything an entity declares depends on the stored rows. If not, it is written without looking at them."""
    return bool(spec.delta or spec.on_insert or spec.on_changed or spec.on_unchanged or spec.slug or spec.surrogate or spec.orphans)


def run_entity(
    spec: EntitySpec, source: DataFrame, store, tables: Mapping[str, DataFrame] | None = None, cache: RunCache | None = None
) -> dict[str, Any]:
    """Classify, write the new content, and read the statistics back from it.

    The source is mapped once; guard, flags, ids and the write read the kept rows. A run that fails leaves the old content.
    In a table of buckets only those with keys of the run are read and written, unless a policy has to look at all rows; an
    entity that needs no stored row is added blindly. Rows with a value that does not fit go to the table ``<target>__rejects``.
    """
    if hasattr(store, "begin"):
        with store.begin() as change:
            return run_entity(spec, source, change, tables, cache)
    with nullcontext(cache) if cache else RunCache(source.sparkSession) as kept:
        watch = Watch()
        target = store.read(spec.target)
        mapped = kept.keep(_mapped(spec, source, target, tables, watch))
        if _guarded(spec) and mapped.isEmpty():
            raise ValueError(REFUSED.format(spec.name))
        state = store.state(spec.target) if hasattr(store, "replace_buckets") else None
        bucketed = state is not None and state.buckets > 1
        if bucketed and not needs_existing(spec) and tuple(spec.keys) == state.keys:
            stats = _add_blindly(spec, mapped, store)
        elif bucketed and not spec.orphans:
            touched = [r[0] for r in mapped.select(state.bucket().alias("b")).distinct().collect()]
            some = store.read(spec.target, touched)
            classified = _classify(spec, mapped, some, target, lambda: mapped)
            written = store.replace_buckets(spec.target, classified, touched, drop_on_read=["action"])
            stats = _counted(spec, mapped, some, written, watch)
        else:
            classified = _classify(spec, mapped, target, target, lambda: mapped)
            written = store.write(spec.target, classified, drop_on_read=["action"])
            stats = _counted(spec, mapped, target, written, watch)
        stats = {**watch.stats(), **stats}
        refused_rows = f"{spec.target}__rejects"
        if stats["errors"] or store.exists(refused_rows):
            store.write(refused_rows, listed(mapped, spec.keys, spec.name))
        return stats


def _counted(spec: EntitySpec, mapped: DataFrame, target: DataFrame, written: DataFrame, watch: Watch) -> dict[str, int]:
    """Counts by source row: those of the written actions, unless keys are repeated within the run."""
    stats = sync_stats(written).first().asDict()
    if watch.fit() == sum(stats[n] for n in ("inserted", "updated", "unchanged")):
        return stats
    counts = row_stats(key_steps(spec, mapped, target)).first()
    return stats | {n: counts[n] for n in ("inserted", "updated", "unchanged")}


def _add_blindly(spec: EntitySpec, mapped: DataFrame, store) -> dict[str, None]:
    """The rows of a run as files of their own; what they replace is not known. Buckets with many of them are merged."""
    columns = [c for c in mapped.columns if not c.startswith("__") and c in store.state(spec.target).shown().names]
    order = _run_order(spec)
    store.append_delta(spec.target, mapped.where("NOT __bad").select(*columns, *[c.split()[0] for c in order]), order)
    store.compact(spec.target, MOST_DELTAS)
    return dict.fromkeys(("inserted", "updated", "unchanged"), None) | {"orphans": 0}


def run_targets(
    specs: Sequence[EntitySpec], source: DataFrame, store, tables: Mapping[str, DataFrame] | None = None
) -> dict[str, dict[str, Any]]:
    """Several target tables from one scan of the source, committed together; statistics by target.

    The columns of all targets are mapped in one pass and kept; each target then reads its own. A target may look up rows of
    those before it. ``store`` has to know transactions: if one target fails, none is changed.
    """
    asked = {}
    for i, spec in enumerate(specs):
        asked |= {f"__{i}_{c}": as_column(v) for c, v in spec.columns.items()}
        asked |= {f"__{i}_order{j}": F.col(c.split()[0]) for j, c in enumerate(spec.order)}
        asked |= {f"__{i}_ordinal": F.col(spec.ordinal)} if spec.ordinal else {}
    stats = {}
    with store.begin() as change, RunCache(source.sparkSession) as kept:
        rows = kept.keep(source.select(*[v.alias(n) for n, v in asked.items()]))
        for i, spec in enumerate(specs):
            own = replace(
                spec,
                columns={c: F.col(f"__{i}_{c}") for c in spec.columns},
                order=[f"__{i}_order{j}" + c[len(c.split()[0]) :] for j, c in enumerate(spec.order)],
                ordinal=f"__{i}_ordinal" if spec.ordinal else None,
            )
            stats[spec.target] = run_entity(own, rows, change, ChainMap(dict(tables or {}), change.tables()), kept)
    return stats


def run_entity_batch(spec: EntitySpec, source: DataFrame, store, tables: Mapping[str, DataFrame] | None = None) -> dict[str, Any]:
    """Set-based variant without delta, flags and orphans: matched rows are replaced as a whole.

    One pass over the source, whose counts are taken on the way; rows with a value that does not fit are errors, kept in the
    table ``<target>__rejects``.
    """
    with RunCache(source.sparkSession) as kept:
        watch = Watch()
        target = store.read(spec.target)
        rows = kept.keep(_mapped(spec, source, target, tables, watch))
        good = rows.where("NOT __bad")
        top = target.agg(F.max(spec.surrogate)).first()[0] or 0 if spec.surrogate else 0
        order = _run_order(spec)
        wide = target.withColumns({c.split()[0]: F.lit(None).cast(rows.schema[c.split()[0]].dataType) for c in order})
        columns = [c for c in good.columns if c in wide.columns]
        merged = replace_merge(wide, good.select(*columns), list(spec.keys), order, spec.surrogate, top)
        before = target.count()  # from the footers of its files
        after = Observation()
        store.write(spec.target, merged.select(*target.columns).observe(after, F.count("*").alias("n")))
        stats = watch.stats()
        inserted = after.get["n"] - before
        if stats["errors"] or store.exists(f"{spec.target}__rejects"):
            store.write(f"{spec.target}__rejects", listed(rows, spec.keys, spec.name))
        return {**stats, "inserted": inserted, "updated": stats["processed"] - stats["skipped"] - stats["errors"] - inserted}


def run_entities(
    spark: SparkSession,
    specs: Sequence[EntitySpec],
    sources: Mapping[str, Callable[[], DataFrame]],
    store,
    names: Sequence[str] | None = None,
    lookups: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Run the entities in the given order, or only those named. One row of statistics each.

    An entity that fails is reported with its error and the run goes on. A source that several entities read is scanned
    once and kept until the run ends.
    """
    rows = []
    chosen = [s for s in specs if names is None or s.name in names]
    uses = Counter(s.source for s in chosen)
    with RunCache(spark) as cache:
        for spec in chosen:
            try:
                source = sources[spec.source]()
                source = cache.keep(source, f"source {spec.source}") if uses[spec.source] > 1 else source
                stats = run_entity(spec, source, store, ChainMap(lookups or {}, store.tables()), cache)
                rows.append({"entity": spec.name, **stats, "error": None})
            except Exception as error:
                rows.append({"entity": spec.name, "error": (str(error).splitlines() or [repr(error)])[0]})
    columns = [c.split()[0] for c in STATS_SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(r.get(c) for c in columns) for r in rows], STATS_SCHEMA)


def run_totals(stats: DataFrame, entities: Sequence[str] | None = None) -> DataFrame:
    """Totals over a fixed list of entities, or all: rows processed; rows in error and entities that failed."""
    rows = stats if entities is None else stats.where(F.col("entity").isin(*entities))
    return rows.agg(
        F.coalesce(F.sum("processed"), F.lit(0)).alias("processed"),
        (F.coalesce(F.sum("errors"), F.lit(0)) + F.count_if(F.col("error").isNotNull())).alias("errors"),
    )

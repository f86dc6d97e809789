"""N-gram Jaccard join as a blocked sparse matrix product of the document by n-gram incidence with its transpose.

Equal sets are one row of the matrix. Most rows are discarded before any product: a row needs as many columns that
another row has, too, as its size demands of the overlap, first among its first columns in a fixed order, then among all. Of
the rows left, only the rarest columns can make pairs: two similar rows share one of them. In each such column every row
meets one of them, its hub; overlaps of a hub with a block of rows are one sparse product, and what is linked becomes one
component. In columns that still have different ones, first one row of each component is paired with those of the others,
which joins the parts of large groups of near copies, and then all rows that are left in different components; only pairs are
multiplied whose sizes, places in the column order and bitmaps allow the overlap. So no column emits all its pairs, and none is
capped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .batches import map_columns, pieces, stored
from .components import components
from .near_duplicates import shingles

#: Of the first columns of a row, one in this many of all has to be shared beyond the one that any pair shares. Any number is exact.
EXTRA = 5
#: Bytes of sets that are multiplied with one hub in a block, about.
BLOCK_BYTES = 1 << 18
#: Bits of a column that are compared when rows are discarded by their first columns. Columns that agree in them pass for shared, which
#: at most keeps a row; any number is exact.
FOLDED = 40
#: Words of 64 bits in the bitmap of a set.
WORDS = 16
#: Classes up to which a list of them (some 30 bytes each) is broadcast to find their rows; above, both sides are shuffled.
BROADCAST = 400_000


def _needed(n: str, percent: int) -> str:
    """SQL: columns that a row of n columns shares with any similar row at least."""
    return f"(({percent} * {n} + 99) div 100)"


def _sure(n: str, percent: int) -> str:
    """SQL: shared columns that two similar rows, of which the smaller has n columns, have among their first ones."""
    return f"least({_needed(n, percent)}, {n} div {EXTRA} + 1)"


def _described(documents: DataFrame, size: int, percent: int) -> DataFrame:
    """doc_id, key (to find the text again), n, class (digest of the set) and the set's first columns of every row."""

    def start():
        def rows(at):
            found = [shingles(t, size) for t in at["text"]]
            firsts = []
            for s in found:
                need = (percent * len(s) + 99) // 100
                firsts.append(s[: len(s) - need + min(need, len(s) // EXTRA + 1)].view(np.int64).tolist())
            return {"doc_id": at["doc_id"], "key": at["key"], "n": [len(s) for s in found], "class": [_digest(s) for s in found], "firsts": firsts}

        return rows

    return map_columns(_keyed(documents), "doc_id long, key long, n long, class binary, firsts array<long>", start)


def _digest(found: np.ndarray) -> bytes | None:
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None


def _keyed(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long"), "text").withColumn("key", F.xxhash64("doc_id", "text"))


def _listed(classes: DataFrame) -> DataFrame:
    return F.broadcast(classes) if classes.count() <= BROADCAST else classes


def _alone(incidence: DataFrame) -> DataFrame:
    """id and lone: the number of columns of each row that no other row of `incidence` (id, gram) has, at most.

    Columns are told apart by FOLDED of their bits, as whole ones do not pack in a shuffle.
    """
    folded = incidence.select("id", F.col("gram").bitwiseAND(F.lit((1 << FOLDED) - 1)).alias("gram"))
    columns = folded.groupBy("gram").agg(F.count("*").alias("often"), F.min("id").alias("id"))
    return columns.filter("often = 1").groupBy("id").agg(F.count("*").alias("lone"))


def _sets(documents: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """id, n and set of the wanted classes (id, key, class), from the texts; a text of another set is passed over."""
    met = _keyed(documents).join(_listed(wanted), "key").select("text", "class", "id")

    def start():
        def rows(at):
            found = [(i, s) for i, c, s in zip(at["id"], at["class"], (shingles(t, size) for t in at["text"])) if _digest(s) == c]
            return {"id": [i for i, _ in found], "n": [len(s) for _, s in found], "set": [s.tobytes() for _, s in found]}

        return rows

    return map_columns(met, "id long, n long, set binary", start).dropDuplicates(["id"])


def _incidence(sets: DataFrame) -> DataFrame:
    """id and gram of every cell of the matrix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                found = [np.frombuffer(s, np.int64) for s in part.column(1).to_pylist()]
                ids = np.repeat(part.column(0).to_numpy(), [len(f) for f in found])
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(np.concatenate(found))], names=["id", "gram"])

    return sets.select("id", "set").mapInArrow(run, "id long, gram long")


def _rare(sets: DataFrame, percent: int) -> DataFrame:
    """The cells in which pairs are looked for: gram, id, n, shared (columns that others have, too) and place among those.

    Columns are in order of rarity. Those that no other row has come first; they cannot be shared and count for the length.
    """
    cells = stored(_incidence(sets), "cells")
    often = stored(cells.groupBy("gram").agg(F.count("*").alias("often")).filter("often > 1"), "columns")
    met = cells.join(often, "gram").join(sets.select("id", "n"), "id")
    own = Window.partitionBy("id")
    met = met.withColumn("place", F.row_number().over(own.orderBy("often", "gram"))).withColumn("shared", F.count("*").over(own))
    return met.filter(f"place <= shared - {_needed('n', percent)} + 1").select("gram", "id", "n", "shared", "place")


def product(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """a, b and common of the pairs (a, b) whose overlap is large enough for their sizes.

    The rows b of one a are dealt to blocks of bounded bytes; every block holds the set of a once. Blocks are settled by sizes, so that
    the sets are shuffled twice only: to their places, and with those to the blocks.
    """
    pairs = stored(pairs, "pairs")
    sizes = sets.select(F.col("id").alias("b"), "n")
    blocks = pairs.join(sizes, "b").groupBy("a").agg((F.expr(f"sum(n) * 8 div {BLOCK_BYTES}") + 1).alias("blocks"))
    member = pairs.join(blocks, "a").select("a", F.expr("pmod(xxhash64(b), blocks)").alias("block"), "b", F.col("b").alias("id"))
    hub = blocks.select("a", F.explode(F.expr("sequence(0L, blocks - 1)")).alias("block"), F.lit(None).cast("long").alias("b"), F.col("a").alias("id"))
    rows = hub.union(member).join(sets.select("id", "set"), "id").select("a", "block", "b", "set")
    rows = rows.repartition("a", "block").sortWithinPartitions("a", "block", "b")  # the null, that is the hub, comes first

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, a = np.zeros(0, np.uint64), None
        for batch in batches:
            for part in pieces(batch):
                out: list[tuple[int, int, int]] = []
                others: list[tuple[int, np.ndarray]] = []
                for at, _, b, data in zip(*(c.to_pylist() for c in part.columns)):
                    found = np.frombuffer(data, np.uint64)
                    if b is None:
                        out += _overlaps(a, own, others, percent)
                        own, a, others = found, at, []
                    else:
                        others.append((b, found))
                out += _overlaps(a, own, others, percent)
                cols = list(zip(*out)) if out else [()] * 3
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["a", "b", "common"])

    return rows.mapInArrow(run, "a long, b long, common long")


def _overlaps(a: int | None, own: np.ndarray, others: list[tuple[int, np.ndarray]], percent: int) -> list[tuple[int, int, int]]:
    """The product of one row with a block of rows, less what is below the bound: 100 * common >= percent * union."""
    if not others:
        return []
    sizes = np.array([len(s) for _, s in others])
    cells = np.concatenate([s for _, s in others])
    hit = own[np.minimum(np.searchsorted(own, cells), len(own) - 1)] == cells
    common = np.add.reduceat(hit.astype(np.int64), np.cumsum(sizes) - sizes)
    keep = 100 * common >= percent * (len(own) + sizes - common)
    return [(a, others[i][0], int(common[i])) for i in np.flatnonzero(keep)]


def _hubs(at: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of each column's hub with its other rows. Rows that share many columns meet few different hubs."""
    hubs = at.groupBy("gram").agg(F.min(F.struct(F.xxhash64("id").alias("h"), "id", "n")).alias("hub"))
    hubs = hubs.select("gram", F.col("hub.id").alias("a"), F.col("hub.n").alias("n_a"))
    met = at.join(hubs, "gram").filter(f"id <> a AND 100 * least(n, n_a) >= {percent} * greatest(n, n_a)")
    return met.select("a", F.col("id").alias("b")).distinct()


def _speakers(at: DataFrame) -> DataFrame:
    """Of each column one cell for every component."""
    first = F.min(F.struct(F.xxhash64("id").alias("h"), "id", "n", "shared", "place")).alias("first")
    return at.groupBy("gram", "root").agg(first).select("gram", "root", "first.id", "first.n", "first.shared", "first.place")


def _bitmaps(sets: DataFrame) -> DataFrame:
    """id and bits: a bit for every value of the lowest bits of a set's columns."""

    def start():
        def rows(at):
            bits = []
            for s in at["set"]:
                marks = np.zeros(64 * WORDS, np.uint8)
                marks[np.frombuffer(s, np.uint64) % np.uint64(64 * WORDS)] = 1
                bits.append(np.packbits(marks).view(np.int64).tolist())
            return {"id": at["id"], "bits": bits}

        return rows

    return map_columns(sets.select("id", "set"), "id long, bits array<long>", start)


def _open(at: DataFrame) -> DataFrame:
    """The cells of columns in which different components are left."""
    split = at.groupBy("gram").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high").select("gram")
    return at.join(split, "gram")


def _rest(at: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of rows in different components that share a rare column and could overlap enough for their sizes.

    Two bounds of the overlap are tested within the join: the columns that are left after the places of the shared one, and
    the bits in which bitmaps differ, each of which stands for a column that one row lacks.
    """
    at = stored(at.join(_bitmaps(sets), "id"), "open")  # of all sets: a bitmap is smaller than a set to be shuffled
    other = at.select("gram", *(F.col(c).alias(f"{c}_b") for c in ("id", "n", "shared", "place", "root", "bits")))
    fits = f"100 * least(n, n_b) >= {percent} * greatest(n, n_b)"
    early = f"(100 + {percent}) * (1 + least(shared - place, shared_b - place_b)) >= {percent} * (n + n_b)"
    apart = " + ".join(f"bit_count(bits[{i}] ^ bits_b[{i}])" for i in range(WORDS))
    near = f"(100 + {percent}) * ((n + n_b - ({apart})) div 2) >= {percent} * (n + n_b)"
    met = at.join(other, "gram").filter(f"id < id_b AND root <> root_b AND {fits} AND {early} AND {near}")
    return met.select(F.col("id").alias("a"), F.col("id_b").alias("b")).distinct()


def _joined_by(roots: DataFrame, links: DataFrame) -> DataFrame:
    """id and root after links (a, b) have joined the components of their ends."""
    ends = links.select("a", "b").join(roots.select(F.col("id").alias("a"), F.col("root").alias("u")), "a")
    ends = ends.join(roots.select(F.col("id").alias("b"), F.col("root").alias("v")), "b").select(F.col("u").alias("a"), F.col("v").alias("b"))
    found = components(ends.distinct()).select(F.col("node").alias("root"), F.col("root").alias("joined"))
    return stored(roots.join(found, "root", "left").select("id", F.coalesce("joined", "root").alias("root")), "roots")


def _components(sets: DataFrame, percent: int) -> DataFrame:
    """id and root of every row of the matrix."""
    roots = sets.select("id", F.col("id").alias("root"))
    at = stored(_rare(sets, percent), "rare")
    steps = (lambda at: _hubs(at, percent), lambda at: _rest(_speakers(at), sets, percent), lambda at: _rest(at, sets, percent))
    for pairs in steps:
        at = stored(_open(at.drop("root").join(roots, "id")), "open")
        if at.isEmpty():
            break
        roots = _joined_by(roots, stored(product(pairs(at), sets, percent), "links"))
    return roots


def joined(documents: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and n_same of every row.

    Rows with 100 * intersection >= percent * union of their sets of `size`-word shingles are linked; component_id is the
    smallest id that links lead to, and n_same the number of rows with the same set, itself included (0 for the empty set).
    Null and empty texts, and those without a word, have the empty set and are linked with nothing. Equal texts are linked
    whatever their ids, so repeated rows have equal results. A null id is never the smallest; component_id is null if the group has no other.
    Other columns are not read; an empty table gives no rows.
    """
    described = stored(_described(documents, size, percent), "described")
    filled = described.filter("class IS NOT NULL")
    classes = filled.groupBy("class").agg(F.min("doc_id").alias("least"), F.min("key").alias("key"), F.max("n").alias("n"), F.count("*").alias("same"))
    classes = stored(classes.withColumn("id", F.monotonically_increasing_id()), "classes")  # ids hold once they are written

    # rows that share too few of their first columns have no similar row
    firsts = filled.select("key", "class", "firsts").join(_listed(classes.select("key", "class", "id")), ["key", "class"])
    lone = _alone(firsts.select("id", F.explode("firsts").alias("gram")))  # a repeated row shares with itself and stays
    length = f"n - {_needed('n', percent)} + {_sure('n', percent)}"
    near = classes.join(lone, "id", "left").filter(f"{length} - coalesce(lone, 0L) >= {_sure(_needed('n', percent), percent)}")
    sets = stored(_sets(documents, stored(near.select("id", "key", "class"), "wanted"), size), "sets")

    roots = _components(sets, percent)
    linked = classes.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    least = linked.groupBy("root").agg(F.min("least").alias("smallest"))
    ids = linked.join(least, "root").select("class", "same", "smallest")
    out = described.select("doc_id", "n", "class").join(ids, "class", "left")
    found = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("smallest")).alias("component_id")
    return out.select("doc_id", F.col("n").alias("n_shingles"), found, F.coalesce("same", F.lit(0).cast("long")).alias("n_same"))

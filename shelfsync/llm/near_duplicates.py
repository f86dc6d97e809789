"""Near duplicates by HyperMinHash, confirmed on full shingle sets.

The hashes of a document's shingles fall into buckets; of each bucket's smallest hash the register keeps the
number of leading zeros and some bits after them. Bands of registers give candidates, a Jaccard estimate corrected for
chance collisions of registers drops most of the wrong ones, and the shingle sets decide the rest.

Documents with equal sets form a class first, so copies cost nothing afterwards. In a band bucket, every
class is compared with one class of the bucket, a different one in each band. Members that then still belong to
different components of one bucket are compared through the rarest shingles of each (two sets of the required
similarity share one of those), so that no bucket has to emit all its pairs and none has a cap.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .batches import map_columns, pieces, stored
from .components import components

REGISTERS = 128
MANTISSA = 10
BAND = 4  # registers of a band: four of 16 bits are one number of 64 bits
BANDS = REGISTERS // BAND
#: Width, in standard deviations, of the margin that the estimate gets below the threshold.
MARGIN = 7.0
#: Classes up to which the list of wanted texts is broadcast (24 bytes each); above, both sides are shuffled.
BROADCAST = 400_000
PIECE = 1 << 20
#: Words of 64 bits in the bitmap of a set.
WORDS = 32

_rng = np.random.default_rng(20240601)
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]  # A-Z as a-z
_POWER = np.cumprod(np.full(1 << 16, 0x9E3779B97F4A7C15, dtype=np.uint64))
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_PROBES = _rng.integers(0, REGISTERS, (REGISTERS, 256))
_EDGES = np.arange(REGISTERS, dtype=np.uint64) << np.uint64(57)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hashes(data: bytes) -> np.ndarray:
    a = np.frombuffer(data, dtype=np.uint8)
    space = _SPACE[a]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]]).view(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    place = np.arange(len(a)) - np.repeat(starts, np.diff(np.append(starts, len(a))))[-len(a) :] if starts[0] == 0 else None
    if place is None:
        place = np.arange(len(a)) - np.repeat(np.concatenate([[0], starts]), np.diff(np.concatenate([[0], starts, [len(a)]])))
    value = (_BYTE[a] + (place >> 16).astype(np.uint64)) * _POWER[place & 0xFFFF]
    value[space] = 0
    return mixed(np.add.reduceat(value, starts) + (ends - starts).astype(np.uint64))


def word_hashes(text: str) -> np.ndarray:
    """One number for each word, A-Z counting as a-z. Long texts are hashed in pieces cut at white space."""
    data = text.encode("utf-8", "surrogatepass")
    if len(data) <= PIECE:
        return _hashes(data)
    cut = np.flatnonzero(_SPACE[np.frombuffer(data, dtype=np.uint8)])
    out, at = [], 0
    while at < len(data):
        k = np.searchsorted(cut, at + PIECE)
        end = int(cut[k]) if k < len(cut) else len(data)
        out.append(_hashes(data[at:end]))
        at = end
    return np.concatenate(out)


def shingles(text: str | None, size: int) -> np.ndarray:
    """The sorted set of hashes of all runs of `size` words; of fewer words, of all of them as one."""
    w = word_hashes(text) if text else np.zeros(0, np.uint64)
    size = min(size, len(w))
    if not size:
        return np.zeros(0, np.uint64)
    acc = np.full(len(w) - size + 1, size, np.uint64)
    for i in range(size):
        acc = mixed(acc * np.uint64(0xD6E8FEB86659FD93) + w[i : len(w) - size + 1 + i])
    return np.unique(acc)


def sketch(sets: np.ndarray) -> np.ndarray:
    """The registers of a set that is not empty. Empty registers borrow a full one, by a fixed order of their own."""
    first = np.searchsorted(sets, _EDGES)
    value = sets[np.minimum(first, len(sets) - 1)]
    full = (first < len(sets)) & ((value >> np.uint64(57)) == np.arange(REGISTERS, dtype=np.uint64))
    rest = (value & np.uint64((1 << 57) - 1)) >> np.uint64(4)  # 53 bits, exact as a float
    zeros = (53 - np.frexp(rest.astype(np.float64))[1]).astype(np.uint64)
    bits = ((rest << zeros) >> np.uint64(52 - MANTISSA)) & np.uint64((1 << MANTISSA) - 1)
    out = ((zeros << np.uint64(MANTISSA)) | bits).astype(np.uint16)
    if not full.all():
        empty = np.flatnonzero(~full)
        hit = full[_PROBES[empty]]
        at = _PROBES[empty, hit.argmax(axis=1)]
        filled = np.flatnonzero(full)
        spare = filled[np.searchsorted(filled, empty) % len(filled)]
        out[empty] = out[np.where(hit.any(axis=1), at, spare)]
    return out


def estimate(a: np.ndarray, b: np.ndarray, n_a: int, n_b: int) -> float:
    """Jaccard similarity from two sketches, less what different hashes agree by chance.

    The chance of a collision in a register is 0.1699 * phi / 2**MANTISSA with phi = 4 n m / (n + m)**2.
    """
    chance = 0.169919487159739093975315 * 4 * n_a * n_b / (n_a + n_b) ** 2 / (1 << MANTISSA)
    return max(0.0, (float((a == b).mean()) - chance) / (1 - chance))


def _lowest(percent: int) -> float:
    t = percent / 100
    return t - MARGIN * math.sqrt(t * (1 - t) / REGISTERS)


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union, on the sets themselves."""
    if len(a) > len(b):
        a, b = b, a
    if 100 * len(a) < percent * len(b):
        return False
    common = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def _described(documents: DataFrame, size: int) -> DataFrame:
    """doc_id, key (of id and text), n, class (digest of the set) and sketch of every row."""

    def start():
        def rows(at):
            found = [shingles(t, size) for t in at["text"]]
            return {
                "doc_id": at["doc_id"],
                "key": at["key"],
                "n": [len(s) for s in found],
                "class": [_digest(s) for s in found],
                "sketch": [sketch(s).tobytes() if len(s) else None for s in found],
            }

        return rows

    return map_columns(_keyed(documents), "doc_id long, key long, n long, class binary, sketch binary", start)


def _digest(found: np.ndarray) -> bytes | None:
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None


def _keyed(documents: DataFrame) -> DataFrame:
    at = documents.select(F.col("doc_id").cast("long"), "text")
    return at.withColumn("key", F.xxhash64("doc_id", "text"))


def _sets(documents: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """class and set of the wanted classes (class, key), from their texts."""
    small = wanted.count() <= BROADCAST
    met = _keyed(documents).join(F.broadcast(wanted) if small else wanted, "key").select("text", "class")

    def start():
        def rows(at):
            found = [(c, s.tobytes()) for c, s in zip(at["class"], (shingles(t, size) for t in at["text"])) if _digest(s) == c]
            return {"class": [c for c, _ in found], "set": [s for _, s in found]}

        return rows

    return stored(map_columns(met, "class binary, set binary", start).dropDuplicates(["class"]), "sets")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose sets are similar enough."""
    lowest = _lowest(percent)
    left = sets.select(F.col("class").alias("a"), F.col("set").alias("left"))
    right = sets.select(F.col("class").alias("b"), F.col("set").alias("right"))

    def start():
        def rows(at):
            keep = []
            for x, y in zip(at["left"], at["right"]):
                a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                keep.append(estimate(sketch(a), sketch(b), len(a), len(b)) >= lowest and similar(a, b, percent))
            return {n: [v for v, k in zip(at[n], keep) if k] for n in ("a", "b")}

        return rows

    met = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
    return map_columns(met, "a binary, b binary", start)


def _shingles_of(sets: DataFrame) -> DataFrame:
    """One row for each member of the sets: id and shingle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                found = [np.frombuffer(s, np.int64) for s in part.column(1).to_pylist()]
                ids = np.repeat(part.column(0).to_numpy(), [len(f) for f in found])
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(np.concatenate(found))], names=["id", "shingle"])

    return sets.select("id", "set").mapInArrow(run, "id long, shingle long")


def _rare(sets: DataFrame, percent: int) -> DataFrame:
    """The rarest shingles of each set, as many as a similar set must share one of: class, root, n, bits, lone, shingle.

    Shingles that no other set holds come first in that order, and cannot be shared; `lone` is their number.
    """
    members = _shingles_of(sets.withColumn("id", F.xxhash64("class")))
    often = members.groupBy("shingle").agg(F.count("*").alias("often")).filter("often > 1")
    met = members.join(often, "shingle")
    sized = map_columns(sets.select("class", "root", "set"), "class binary, root binary, n long, bits array<long>", _bitmaps)
    sized = sized.withColumn("id", F.xxhash64("class"))
    own = Window.partitionBy("id")
    met = met.withColumn("place", F.row_number().over(own.orderBy("often", "shingle"))).withColumn("shared", F.count("*").over(own))
    met = met.join(sized, "id").withColumn("lone", F.col("n") - F.col("shared"))
    length = f"n - ({percent} * n + 99) div 100 + 1"
    return met.filter(f"place <= {length} - lone").select("class", "root", "n", "bits", "lone", "shingle")


def _bitmaps():
    """A bit for every value of the lowest bits of a set's hashes."""

    def rows(at):
        sizes, bits = [], []
        for s in at["set"]:
            a = np.frombuffer(s, np.uint64)
            marks = np.zeros(64 * WORDS, np.uint8)
            marks[a & np.uint64(64 * WORDS - 1)] = 1
            sizes.append(len(a))
            bits.append(np.packbits(marks).view(np.int64).tolist())
        return {"class": at["class"], "root": at["root"], "n": sizes, "bits": bits}

    return rows


def _rest(sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of sets in different components that share one of their rarest shingles and could be similar enough.

    Two bounds on the intersection are tested in the join itself, so that hopeless pairs are not emitted: what a set holds
    alone is not in it; and every bit in which two bitmaps differ stands for a shingle that one set lacks.
    """
    rare = stored(_rare(sets, percent), "rare")
    other = rare.select("shingle", F.col("class").alias("b"), F.col("root").alias("root_b"), F.col("n").alias("n_b"), F.col("lone").alias("lone_b"), F.col("bits").alias("bits_b"))
    apart = " + ".join(f"bit_count(bits[{i}] ^ bits_b[{i}])" for i in range(WORDS))
    common = f"least(n - lone, n_b - lone_b, (n + n_b - ({apart})) div 2)"
    met = rare.withColumnRenamed("class", "a").join(other, "shingle")
    return met.filter(f"a < b AND root <> root_b AND (100 + {percent}) * {common} >= {percent} * (n + n_b)").select("a", "b").distinct()


def _grouped(documents: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The described rows, and for every class its component: class, root and the smallest id."""
    described = stored(_described(documents, size), "described")
    classes = described.filter("class IS NOT NULL").groupBy("class").agg(
        F.min("doc_id").alias("least"), F.min("key").alias("key"), F.max("n").alias("n"), F.max("sketch").alias("sketch")
    )
    classes = stored(classes, "classes")
    band = classes.select("class", "n", "sketch", F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("i"))
    band = band.select("class", "n", F.xxhash64("i", F.expr(f"substring(sketch, i * {2 * BAND} + 1, {2 * BAND})")).alias("bucket"))
    centre = F.min(F.struct(F.xxhash64("bucket", "class").alias("place"), F.col("class").alias("centre"), F.col("n").alias("n_centre")))
    shared = band.groupBy("bucket").agg(centre.alias("c"), F.count("*").alias("size")).filter("size > 1")
    shared = shared.select("bucket", "size", "c.centre", "c.n_centre")
    met = stored(band.join(shared, "bucket").filter("class <> centre"), "met")
    fits = f"100 * least(n, n_centre) >= {percent} * greatest(n, n_centre)"
    pairs = met.filter(fits).select(F.least("class", "centre").alias("a"), F.greatest("class", "centre").alias("b")).distinct()
    wanted = met.select("class").union(met.select("centre")).distinct().join(classes.select("class", "key"), "class")
    sets = _sets(documents, stored(wanted, "wanted"), size)
    links = stored(_confirmed(pairs, sets, percent), "links")
    roots = stored(components(links), "roots")

    # members of one bucket that are still in different components, apart from the centre, which has met all
    crowded = met.filter("size > 2").select("bucket", "class").join(roots.withColumnRenamed("node", "class"), "class", "left")
    crowded = crowded.select("bucket", "class", F.coalesce("root", "class").alias("root"))
    split = crowded.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high")
    open_ = stored(crowded.join(split.select("bucket"), "bucket", "left_semi").select("class", "root").distinct(), "open")
    if not open_.isEmpty():
        more = stored(_confirmed(_rest(sets.join(open_, "class"), percent), sets, percent), "links")
        if not more.isEmpty():
            roots = stored(components(links.union(more)), "roots")

    linked = roots.join(classes.select(F.col("class").alias("node"), "least"), "node")
    linked = linked.join(linked.groupBy("root").agg(F.min("least").alias("smallest")), "root")
    ids = classes.select("class", "least").join(linked.select(F.col("node").alias("class"), "root", "smallest"), "class", "left")
    smallest = F.when(F.col("root").isNotNull(), F.col("smallest")).otherwise(F.col("least"))
    return described, ids.select("class", F.coalesce("root", "class").alias("root"), smallest.alias("smallest"))


def groups(documents: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row.

    Rows with a similarity of `percent` or more are linked; component_id is the smallest id that links lead to.
    Null and empty texts, and those without a word, have the empty set, are linked with nothing and kept. Equal texts
    are linked whatever their ids; repeated rows have equal results. A null id is never the smallest; if a group
    has no other, component_id is null. `kept` is whether doc_id is component_id, nulls being equal.
    """
    described, ids = _grouped(documents, size, percent)
    out = described.select("doc_id", "n", "class").join(ids.select("class", "smallest"), "class", "left")
    found = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("smallest"))
    out = out.select("doc_id", F.col("n").alias("n_shingles"), found.alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def representatives(documents: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `documents`, all their columns, of which one row of each group stays.

    That is the one with the smallest id (null ids last, then by a hash of the text; of rows that repeat id and text
    the first by their other columns). Rows without words stay, all of them.
    """
    described, ids = _grouped(documents, size, percent)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("key"))).alias("first")
    rows = described.join(ids.select("class", "root"), "class", "left")
    best = rows.filter("class IS NOT NULL").groupBy("root").agg(first).select("first.key")
    times = described.filter("class IS NOT NULL").groupBy("key").agg(F.count("*").alias("times"))
    keys = stored(best.join(times, "key"), "keys")
    single = keys.filter("times = 1").select("key").union(described.filter("class IS NULL").select("key").distinct())
    many = keys.filter("times > 1").select("key")
    names = documents.columns
    at = documents.withColumn("key__", F.xxhash64(F.col("doc_id").cast("long"), F.col("text")))
    chosen = [k.withColumnRenamed("key", "key__") for k in (single, many)]
    chosen = [F.broadcast(k) if k.count() <= BROADCAST else k for k in chosen]
    order = Window.partitionBy("key__").orderBy(*(n for n in names if n not in ("doc_id", "text")))
    again = at.join(chosen[1], "key__", "left_semi").withColumn("place__", F.row_number().over(order)).filter("place__ = 1")
    return at.join(chosen[0], "key__", "left_semi").select(*names).union(again.select(*names))

"""Hard-negative mining: anchors by candidates as tiles of an integer matrix product, by Strassen's recursion.

A tile holds some hundred anchors and some thousand candidates of one number of dimensions. Its scores are products of
64-bit integers; odd halves are padded with zeros, and all additions are exact. Two passes: the best rows of the anchor's
own label, then, for every anchor and positive, the best rows of other labels whose score lies in the positive's window.
Blocks of anchors meet the candidates of a shard in a merge join, one block after the other, so neither side goes through the
driver. Each task keeps a small heap for each anchor, or anchor and positive; heaps of all tasks are merged by rank.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .batches import stored

#: Anchors and candidates of a tile at most, and bytes of its candidates.
ANCHORS = 256
CANDIDATES = 4096
TILE_BYTES = 4 << 20
#: Parts that the candidates are dealt to at least; more if the session has more shuffle partitions or a part would be larger
#: than so many bytes, as a task holds one. Every block of anchors goes to each.
SPREAD = 32
SHARD_BYTES = 64 << 20
#: Side below which a product is no longer split.
LEAF = 64
#: Heaps that a task holds before it passes them on, once it is done with a block of anchors.
HELD = 20_000
#: Kinds of floats, and whole numbers below which they are exact.
SAFE = ((np.float32, 1 << 24), (np.float64, 1 << 53))
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def usable(vectors: DataFrame, scale: float = 256.0) -> DataFrame:
    """vec_id, label and terms: floor(scale * x) of every component, one row for each id.

    Rows with a null id, label, vector or component take no part, nor do those with a component that is not finite or so large
    that a score might not be a long: in n dimensions, sqrt(2**62 / n) or more after scaling. Of rows that share an id the
    smallest by label and vector counts.
    """
    x = F.transform("embedding", lambda v: F.floor(v.cast("double") * F.lit(scale)).cast("long"))
    most = F.sqrt(F.lit(2.0**62) / F.greatest(F.size("embedding"), F.lit(1)))
    fits = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) * F.lit(scale) < most))
    at = vectors.filter("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL").filter(fits)
    at = at.select(F.col("vec_id").cast("long"), F.struct(F.col("label").cast("long").alias("label"), x.alias("terms")).alias("row"))
    return at.groupBy("vec_id").agg(F.min("row").alias("row")).select("vec_id", "row.label", "row.terms")


def _even(a: np.ndarray) -> np.ndarray:
    """The matrix with a row or column of zeros more where their number is odd."""
    rows, cols = a.shape
    if not (rows % 2 or cols % 2):
        return a
    out = np.zeros((rows + rows % 2, cols + cols % 2), dtype=a.dtype)
    out[:rows, :cols] = a
    return out


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b in integers; by floats, which are faster, if no sum can leave the whole numbers that they hold."""
    largest = [max(int(x.max(initial=0)), -int(x.min(initial=0))) for x in (a, b)]
    for kind, safe in SAFE:
        if a.shape[1] * largest[0] * largest[1] < safe:
            return (a.astype(kind) @ b.astype(kind)).astype(np.int64)
    return a @ b


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b in integers, with seven products of halves instead of eight.

    Sums of 64 bits may wrap in between, which additions undo; only the results have to fit.
    """
    if min(*a.shape, b.shape[1]) <= LEAF:
        return _product(a, b)
    rows, inner, cols = a.shape[0], a.shape[1], b.shape[1]
    a, b = _even(a), _even(b)
    m, k, n = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:m, :k], a[:m, k:], a[m:, :k], a[m:, k:]
    b11, b12, b21, b22 = b[:k, :n], b[:k, n:], b[k:, :n], b[k:, n:]
    # in Winograd's order: eight sums before the products, seven after
    s1 = a21 + a22
    s2 = s1 - a11
    s3 = a11 - a21
    s4 = a12 - s2
    t1 = b12 - b11
    t2 = b22 - t1
    t3 = b22 - b12
    t4 = t2 - b21
    p1 = strassen(a11, b11)
    p5 = strassen(s1, t1)
    u1 = p1 + strassen(s2, t2)
    u2 = u1 + strassen(s3, t3)
    out = np.empty((2 * m, 2 * n), dtype=p1.dtype)
    out[:m, :n] = p1 + strassen(a12, b21)
    out[:m, n:] = u1 + p5 + strassen(s4, b22)
    out[m:, :n] = u2 - strassen(a22, t4)
    out[m:, n:] = u2 + p5
    return out[:rows, :cols]


def _narrow(x: np.ndarray) -> np.ndarray:
    """The same whole numbers in 2, 4 or 8 bytes."""
    kinds = [k for k in (np.int16, np.int32) if x.min(initial=0) >= np.iinfo(k).min and x.max(initial=0) <= np.iinfo(k).max]
    return x.astype((*kinds, np.int64)[0])


def _numbers(column: pa.Array) -> np.ndarray:
    """Values of a column of numbers, or of all lists of a column of lists."""
    return (column.flatten() if pa.types.is_nested(column.type) else column).to_numpy(zero_copy_only=False).astype(np.int64)


def _blocks(at: DataFrame, size: int, key: str, more: tuple[str, ...] = ()) -> DataFrame:
    """Rows packed into blocks of one number of dimensions: width, and as binaries ids, labels, terms and lists in `more`.

    Terms take as many bytes as the largest of a block needs, all else 8.
    """
    names = ["width", f"{key}_ids", f"{key}_labels", f"{key}_terms", *more]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[pa.RecordBatch]] = {}

        def block(width: int, rows: pa.Table) -> pa.RecordBatch:
            cols = [_numbers(c.combine_chunks()) for c in rows.columns]
            cols[2] = _narrow(cols[2])
            return pa.RecordBatch.from_arrays([pa.array([width], pa.int32()), *(pa.array([c.tobytes()], pa.binary()) for c in cols)], names=names)

        for batch in batches:
            widths = pc.list_value_length(batch.column(2)).to_numpy(zero_copy_only=False)
            for width in np.unique(widths).tolist():
                mine = held.setdefault(width, [])
                mine.append(batch.take(pa.array(np.flatnonzero(widths == width))))
                most = max(1, min(size, TILE_BYTES // (8 * max(width, 1))))
                if sum(b.num_rows for b in mine) >= most:
                    rows = pa.Table.from_batches(mine).combine_chunks()
                    whole = rows.num_rows - rows.num_rows % most
                    for first in range(0, whole, most):
                        yield block(width, rows.slice(first, most))
                    held[width] = rows.slice(whole).to_batches()
        for width, left in held.items():
            if left:
                yield block(width, pa.Table.from_batches(left))

    kinds = ", ".join(f"{n} binary" for n in names[1:])
    return at.select("vec_id", "label", "terms", *more).mapInArrow(run, f"width int, {kinds}")


def _tiles(candidates: DataFrame, anchors: DataFrame) -> DataFrame:
    """Every block of candidates next to every block of anchors of the same number of dimensions.

    Both sides are shuffled, never broadcast: the copies of the anchors for all shards grow with the table, and sizes that Spark
    estimates from files do not know of them. A task has one block of anchors after the other, each with all candidates of a
    shard. Numbers of partitions are given, as the work of a task is more than its bytes say.
    """
    size = candidates.agg(F.sum(F.length("c_terms"))).first()[0] or 0
    spread = max(SPREAD, int(candidates.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARD_BYTES))
    left = anchors.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(spread - 1).cast("long"))))
    right = candidates.withColumn("shard", F.pmod(F.xxhash64("c_ids"), F.lit(spread)))
    left, right = (side.repartition(2 * spread, "shard", "width") for side in (left, right))
    return left.join(right.hint("merge"), ["shard", "width"])


def _tile(row: dict) -> tuple[np.ndarray, ...]:
    """Ids and labels of anchors and of candidates, and their scores."""
    a, a_labels, c, c_labels = (np.frombuffer(row[n], np.int64) for n in ("a_ids", "a_labels", "c_ids", "c_labels"))
    width = row["width"]

    def terms(packed: bytes, n: int) -> np.ndarray:
        kind = f"i{len(packed) // (n * width)}" if packed else "i8"
        return np.frombuffer(packed, kind).astype(np.int64).reshape(n, width)

    found = strassen(terms(row["a_terms"], len(a)), np.ascontiguousarray(terms(row["c_terms"], len(c)).T))
    return a, a_labels, c, c_labels, found


def _hits(near: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Rows of a matrix that have any true value, with the places of these."""
    rows, cols = np.divmod(np.flatnonzero(near), max(near.shape[1], 1))
    some, firsts = np.unique(rows, return_index=True)
    yield from zip(some.tolist(), np.split(cols, firsts[1:]))


def _floor(best: list[tuple[int, int]] | None, k: int) -> int:
    """The score that a row has to reach to get among the k best."""
    return best[-1][0] if best and len(best) >= k else LEAST


def _first(ids: np.ndarray, values: np.ndarray, k: int) -> list[tuple[int, int]]:
    """The k best as (score, id), ties to the smaller id."""
    if len(values) > 4 * k + 64:
        stay = values >= np.partition(values, len(values) - k)[len(values) - k]
        ids, values = ids[stay], values[stay]
    found = sorted(zip((-values).tolist(), ids.tolist()))[:k]
    return [(-s, i) for s, i in found]


def _merged(old: list[tuple[int, int]], new: list[tuple[int, int]], k: int) -> list[tuple[int, int]]:
    return sorted(old + new, key=lambda x: (-x[0], x[1]))[:k] if old else new


def _kept(tiles: DataFrame, schema: str, k: int, heaps) -> DataFrame:
    """Rows of the heaps that `heaps` yields for every tile, and those held, as (key, best), merged within a task."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list[tuple[int, int]]] = {}
        last = None

        def flush() -> pa.RecordBatch:
            rows = [(*key, i, s) for key, best in held.items() for s, i in best]
            held.clear()
            cols = list(zip(*rows)) if rows else [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=names)

        for batch in batches:
            for n in range(batch.num_rows):
                row = {name: batch.column(i)[n].as_py() for i, name in enumerate(batch.schema.names)}
                if len(held) > HELD and row["a_ids"] != last:
                    yield flush()
                last = row["a_ids"]
                for key, best in heaps(row, held):
                    held[key] = _merged(held.get(key, []), best, k)
        yield flush()

    return tiles.mapInArrow(run, schema)


def _ranked(rows: DataFrame, k: int, score: str, by: str, *keys: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc(score), by)
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def positives(candidates: DataFrame, anchors: DataFrame, k: int) -> DataFrame:
    """anchor_id, positive_id and positive_score of the k best other rows of each anchor's label."""

    def heaps(row: dict, held: dict):
        a, a_labels, c, c_labels, found = _tile(row)
        floors = np.array([_floor(held.get((i,)), k) for i in a.tolist()], np.int64)
        near = (found >= floors[:, None]) & (c_labels == a_labels[:, None])
        for i, own in _hits(near):
            own = own[c[own] != a[i]]
            if len(own):
                yield (int(a[i]),), _first(c[own], found[i, own], k)

    kept = _kept(_tiles(candidates, anchors), "anchor_id long, positive_id long, positive_score long", k, heaps)
    return _ranked(kept, k, "positive_score", "positive_id", "anchor_id").drop("rank")


def negatives(candidates: DataFrame, anchors: DataFrame, k: int, low: int, high: int) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score; `anchors` hold their positives."""

    def heaps(row: dict, held: dict):
        sizes, ids, values = (np.frombuffer(row[n], np.int64) for n in ("sizes", "positive_ids", "positive_scores"))
        a, a_labels, c, c_labels, found = _tile(row)
        ends, keys = np.cumsum(sizes).tolist(), list(zip(np.repeat(a, sizes).tolist(), ids.tolist(), values.tolist()))
        # what a row has to reach in a window: its least score, or that of the k-th best so far
        windows = [(max(-(-low * key[2] // 100), _floor(held.get(key), k)), high * key[2] // 100) for key in keys]
        parts = [slice(end - n, end) for end, n in zip(ends, sizes.tolist())]
        least = np.array([max(LEAST, min(MOST, min(w[0] for w in windows[part]))) for part in parts], np.int64)
        most = np.array([max(LEAST, min(MOST, max(w[1] for w in windows[part]))) for part in parts], np.int64)
        near = (found >= least[:, None]) & (found <= most[:, None]) & (c_labels != a_labels[:, None])
        for i, other in _hits(near):
            score = found[i, other]
            for key, (lowest, highest) in zip(keys[parts[i]], windows[parts[i]]):
                inside = (score >= lowest) & (score <= highest)
                if inside.any():
                    yield key, _first(c[other[inside]], score[inside], k)

    names = "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"
    kept = _kept(_tiles(candidates, anchors), names, k, heaps)
    ranked = _ranked(kept, k, "negative_score", "negative_id", "anchor_id", "positive_id")
    return ranked.select("anchor_id", "positive_id", F.col("rank").cast("int"), "negative_id", "positive_score", "negative_score")


def mine(rows: DataFrame, anchors: DataFrame, n_positives: int = 5, n_negatives: int = 5, low: int = 80, high: int = 100) -> DataFrame:
    """For every anchor and positive the hardest negatives: anchor_id, positive_id, rank, negative_id and both scores.

    Both tables have vec_id (one row each), label and terms, as `usable` makes them. Scores are integer inner products; ties go to the
    smaller vec_id. Positives are the best other rows of the anchor's label; negatives the best rows of other labels with low *
    positive <= 100 * negative <= high * positive. Only vectors of the anchor's length are compared. Anchors without a positive, and
    positives without a negative in their window (negative scores have an empty one), give no rows, as do empty tables.
    """
    candidates = stored(_blocks(rows, CANDIDATES, "c"), "candidates")
    anchors = stored(anchors, "anchors")
    found = stored(positives(candidates, _blocks(anchors, ANCHORS, "a"), n_positives), "positives")
    lists = found.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("positive_id", "positive_score"))).alias("best"))
    lists = lists.select(
        F.col("anchor_id").alias("vec_id"), F.array(F.size("best").cast("long")).alias("sizes"),
        F.col("best.positive_id").alias("positive_ids"), F.col("best.positive_score").alias("positive_scores"),
    )
    blocks = _blocks(anchors.join(lists.hint("merge"), "vec_id"), ANCHORS, "a", ("sizes", "positive_ids", "positive_scores"))
    return negatives(candidates, blocks, n_negatives, low, high)

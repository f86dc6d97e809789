"""Exact top-k search by MaxScore over vectors of integers.

A term is a dimension; its posting list holds the vectors with a nonzero component there. For a query, every
term has an upper bound of what it can add to a score. Terms sorted by bound split into non-essential ones,
whose bounds together stay below the score of the k-th best so far, and essential ones. Postings of essential
terms are traversed; vectors that could still get into the top k are probed in the other terms, as long as
they are competitive. Vectors are searched in shards; the k best of each shard and query block are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .batches import pieces

#: Vectors of a shard's block and queries of a query block at most.
BLOCK = 8192
QUERIES = 1024
SPREAD = 32
SAFE = 1 << 53


def usable(vectors: DataFrame, scale: float = 256.0) -> DataFrame:
    """vec_id and terms: floor(scale * x) of every component. Rows with a null id, vector or component, or
    with a component that is not finite or of 2**62 or more after scaling, take no part."""
    x = F.transform("embedding", lambda v: F.floor(v.cast("double") * F.lit(scale)))
    whole = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) * F.lit(scale) < F.lit(2.0**62)))
    return vectors.filter("vec_id IS NOT NULL AND embedding IS NOT NULL").filter(whole).select(F.col("vec_id").cast("long"), x.cast("array<long>").alias("terms"))


def _blocks(at: DataFrame, size: int, key: str) -> DataFrame:
    """Rows packed into blocks of at most `size` vectors of one number of dimensions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[int, list[int]]]] = {}

        def block(width: int) -> pa.RecordBatch:
            rows = held.pop(width)
            ids = np.array([r[0] for r in rows], np.int64)
            terms = np.array([r[1] for r in rows], np.int64).reshape(len(rows), width)
            values = [pa.array([width], pa.int32()), pa.array([ids.tobytes()]), pa.array([terms.tobytes()])]
            return pa.RecordBatch.from_arrays(values, names=["width", f"{key}_ids", f"{key}_terms"])

        for batch in batches:
            for part in pieces(batch):
                for row in part.to_pylist():
                    width = len(row["terms"])
                    held.setdefault(width, []).append((row["vec_id"], row["terms"]))
                    if len(held[width]) >= size:
                        yield block(width)
        for width in list(held):
            yield block(width)

    return at.mapInArrow(run, f"width int, {key}_ids binary, {key}_terms binary")


def best(query: np.ndarray, own: int, ids: np.ndarray, terms: np.ndarray, bounds, k: int, floor: int | None):
    """Ids and scores of the query's k best in a block; `floor`: a score that k others have already reached.

    `bounds`: largest and smallest component of every dimension in the block.
    """
    high, low = bounds
    most = np.maximum(query * high, query * low)
    order = np.argsort(most, kind="stable")
    reach = np.cumsum(most[order])  # what the first terms can add together at most
    if floor is not None and len(reach) and reach[-1] < floor:
        return ids[:0], ids[:0]
    split = int(np.searchsorted(np.maximum.accumulate(reach), floor)) if floor is not None and len(reach) else 0
    essential, rest = order[split:], order[:split]
    score = terms[:, essential] @ query[essential]
    at = np.flatnonzero(ids != own)
    part = score[at]
    left = int(most[rest].sum())
    for first in range(len(rest), 0, -8):  # probe the strongest of the remaining terms first
        if floor is not None:
            stay = part + left >= floor
            at, part = at[stay], part[stay]
        probe = rest[max(0, first - 8) : first]
        part = part + terms[np.ix_(at, probe)] @ query[probe]
        left -= int(most[probe].sum())
    if floor is not None:
        stay = part >= floor
        at, part = at[stay], part[stay]
    return _top(ids[at], part, k)


def _top(ids: np.ndarray, scores: np.ndarray, k: int):
    """The k best different ids, ties to the smaller id."""
    if len(ids) > 4 * k + 64:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        stay = scores >= cut
        if len(np.unique(ids[stay])) >= k:
            ids, scores = ids[stay], scores[stay]
    order = np.lexsort((ids, -scores))
    ids, scores = ids[order], scores[order]
    _, firsts = np.unique(ids, return_index=True)
    keep = np.sort(firsts)[:k]
    return ids[keep], scores[keep]


def search(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """The k highest inner products of every query among `vectors`: query_id, rank, vec_id, score.

    Both have vec_id and terms, as `usable` makes them; vectors of other lengths than the query's are no
    candidates, nor is any row with the query's own id. A repeated id counts once, with its best score.
    Blocks of queries meet blocks of vectors; each task keeps the k best it has found for a query and leaves out
    what cannot pass them.
    """
    shards = F.pmod(F.xxhash64("v_ids"), F.lit(SPREAD))
    left = _blocks(vectors, BLOCK, "v").withColumn("shard", shards)
    right = _blocks(queries, QUERIES, "q").withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    met = left.join(right.withColumn("shard", F.col("shard").cast("long")), ["shard", "width"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def flush() -> pa.RecordBatch:
            rows = [(q, v, s) for q, (ids, scores) in found.items() for v, s in zip(ids.tolist(), scores.tolist())]
            found.clear()
            cols = list(zip(*rows)) if rows else [[], [], []]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["query_id", "vec_id", "score"])

        for batch in batches:
            for row in range(batch.num_rows):
                at = {n: batch.column(i)[row].as_py() for i, n in enumerate(batch.schema.names)}
                width = at["width"]
                ids, q_ids = np.frombuffer(at["v_ids"], np.int64), np.frombuffer(at["q_ids"], np.int64)
                terms = np.frombuffer(at["v_terms"], np.int64).reshape(len(ids), width)
                asked = np.frombuffer(at["q_terms"], np.int64).reshape(len(q_ids), width)
                largest = int(np.abs(terms).max(initial=0)) * int(np.abs(asked).max(initial=0)) * max(width, 1)
                kind = np.float64 if largest < SAFE else object  # exact either way
                terms, asked = np.asfortranarray(terms.astype(kind)), asked.astype(kind)
                bounds = (terms.max(axis=0), terms.min(axis=0)) if width else (terms.sum(axis=0),) * 2
                for q, weights in zip(q_ids.tolist(), asked):
                    old = found.get(q)
                    floor = int(old[1][-1]) if old is not None and len(old[0]) >= k else None
                    new, scores = best(weights, q, ids, terms, bounds, k, floor)
                    scores = np.array([max(-(1 << 63), min((1 << 63) - 1, int(s))) for s in scores], np.int64)
                    if old is not None:
                        new, scores = np.concatenate([old[0], new]), np.concatenate([old[1], scores])
                    found[q] = _top(new, scores, k)
                if len(found) > 64 * QUERIES:
                    yield flush()
        yield flush()

    hits = met.mapInArrow(run, "query_id long, vec_id long, score long")
    hits = hits.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int"), "vec_id", "score")

"""Masked pseudo-likelihood of documents under a bidirectional window network.

Every token is predicted from the tokens on both sides of it. The network adds up an embedding of each
neighbour by its distance, bends the sum, and predicts first the token's class and then the token within the class, so
that a prediction costs two small softmaxes. A document's score is the sum of its conditional log-probabilities.

The network tells apart the most frequent words and buckets of all others. A word of a bucket is then predicted within
it, by a table of counts of every word of the corpus, which grows with the input and stays in Spark.

Texts are read and cut into words once. Words are numbered within a chunk of some megabytes of text, and each chunk keeps
the list of its words; counting, coding and scoring of rare words work on these lists, not on every occurrence.

Training is data-parallel: each task runs SGD over every position of its own part of the documents from the common
start, and the models are averaged by the number of positions they have seen. The second round starts from the average.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import map_columns, pieces, stored

#: Classes, and tokens of a class. Tokens beyond the most frequent words share HASHED places by a hash.
CLASSES = 32
WITHIN = 32
VOCABULARY = CLASSES * WITHIN
HASHED = 64
SIDE = 2
WIDTH = 16
ROUNDS = 2
MINI = 1024
SCALE = 64.0
RATE = 1.0
#: Positions of a task between two outputs of what it has learnt.
PART = 1 << 22
WORD = re.compile(r"\w+|[^\w\s]")
#: Bytes of text in a chunk.
CHUNK = 16 << 20
#: Kinds of code points; found by the patterns of WORD when one is first met.
NEW, SPACE, LETTER, SIGN = range(4)
KINDS = np.zeros(0x110000, np.uint8)
PAD = 0
#: Logarithms are summed as whole multiples of 1 / UNIT, so that a sum does not depend on the order of its rows.
UNIT = float(1 << 32)
OFFSETS = np.array([o for o in range(-SIDE, SIDE + 1) if o])
STARTS = VOCABULARY * np.arange(len(OFFSETS))[:, None]
#: Positions that are scored at once.
CUT = 1 << 13
#: Mini-batches that are sorted by class at once.
SORTED = 64
#: Rows of a block of one class in a batched product; a class with more positions in a mini-batch has several.
BLOCK = 3 * MINI // (2 * CLASSES)
ONES = np.ones(max(BLOCK, WITHIN), np.float32)
#: Logits up to this size need no shift before they are raised.
SAFE = 60
#: Cells of each embedding, two floats to a cell.
CELLS = np.arange(len(OFFSETS) * VOCABULARY * WIDTH // 2).reshape(-1, WIDTH // 2)


def words(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def _kinds(points: np.ndarray) -> np.ndarray:
    kinds = KINDS[points]
    new = np.unique(points[kinds == NEW])
    if len(new):
        for point in new.tolist():
            KINDS[point] = SPACE if re.match(r"\s", chr(point)) else LETTER if re.match(r"\w", chr(point)) else SIGN
        kinds = KINDS[points]
    return kinds


def cut_up(texts: list[str | None]) -> tuple[np.ndarray, pa.StringArray]:
    """How many words each text has, and the `words` of all texts one after the other."""
    lower = [f"{t.lower()}\n" if t else "\n" for t in texts]  # the line break ends the last word
    points = np.frombuffer("".join(lower).encode("utf-32-le"), np.uint32)
    kinds = _kinds(points)
    kept, letters = kinds != SPACE, kinds == LETTER
    begins = kept.copy()
    begins[1:] &= ~(letters[1:] & letters[:-1])
    lengths = np.array([len(t) for t in lower])
    sizes = np.add.reduceat(begins, np.cumsum(lengths) - lengths, dtype=np.int64)
    solid = points[kept]
    first = np.flatnonzero(begins[kept])
    offsets = np.append(first, len(solid))
    for least in (0x80, 0x800, 0x10000):  # from there on a code point has one more byte in UTF-8
        offsets += np.searchsorted(np.flatnonzero(solid >= least), np.append(first, len(solid)))
    data = solid.tobytes().decode("utf-32-le").encode()
    return sizes, pa.StringArray.from_buffers(len(first), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data))


def _packed(ids: np.ndarray) -> bytes:
    """The lowest bytes of all numbers, then the next ones: the high ones are mostly zero and take no room when compressed."""
    return ids.view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view(np.int32).ravel()


def lexed(documents: DataFrame) -> DataFrame:
    """Chunks of texts in words: a row of every document (chunk, doc_id, ids) and of every word of a chunk (chunk, id, word, bucket, n)."""
    kind = pa.schema([("chunk", pa.int64()), ("doc_id", pa.int64()), ("ids", pa.binary()), ("id", pa.int32()), ("word", pa.string()), ("bucket", pa.int32()), ("n", pa.int64())])

    def rows(length: int, **columns: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([columns[f.name] if f.name in columns else pa.nulls(length, f.type) for f in kind], schema=kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in pieces(batch, CHUNK):
                cut = [cut_up(few.column(1).to_pylist()) for few in pieces(part, 1 << 20)]  # what fits a processor's cache
                sizes = np.concatenate([c[0] for c in cut])
                found = pa.chunked_array([c[1] for c in cut]).dictionary_encode().combine_chunks()
                ids, own = found.indices.to_numpy(), found.dictionary
                ends = np.cumsum(sizes)
                packed = pa.array([_packed(ids[a:b]) for a, b in zip(ends - sizes, ends)], pa.binary())
                yield rows(len(sizes), chunk=pa.array(np.full(len(sizes), chunk)), doc_id=part.column(0), ids=packed)
                buckets = pa.array(map(bucket, own.to_pylist()), pa.int32())
                n = pa.array(np.bincount(ids, minlength=len(own)), pa.int64())
                yield rows(len(own), chunk=pa.array(np.full(len(own), chunk)), id=pa.array(np.arange(len(own), dtype=np.int32)), word=own, bucket=buckets, n=n)
                chunk += 1

    schema = "chunk long, doc_id long, ids binary, id int, word string, bucket int, n long"
    return stored(documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema), "lexed", compression="zstd")


def counted(documents: DataFrame, chunks: DataFrame | None = None) -> DataFrame:
    """word, bucket (the number it has if it is rare) and n of every word of all documents; `chunks` as `lexed` makes them."""
    chunks = lexed(documents) if chunks is None else chunks
    return stored(chunks.filter("word IS NOT NULL").groupBy("word", "bucket").agg(F.sum("n").alias("n")), "words")


def vocabulary(documents: DataFrame, counts: DataFrame | None = None) -> dict[str, int]:
    """Numbers of the most frequent words, counted over all documents; ties in the order of the words."""
    counts = counted(documents) if counts is None else counts
    rows = counts.orderBy(F.desc("n"), "word").limit(VOCABULARY - 1 - HASHED).collect()
    return {r["word"]: i + 1 for i, r in enumerate(rows)}


def bucket(word: str) -> int:
    """Of HASHED numbers, by length and last letter. Number n belongs to class n % CLASSES, so that every class has frequent and rare words."""
    return VOCABULARY - HASHED + (len(word) * 7 + ord(word[-1])) % HASHED


class Network:
    """Weights as one vector: embeddings by offset, class layer, layers within the classes, and biases."""

    SIZES = (len(OFFSETS) * VOCABULARY * WIDTH, WIDTH * CLASSES, CLASSES, CLASSES * WIDTH * WITHIN, CLASSES * WITHIN)

    def __init__(self, weights: np.ndarray):
        cut = np.cumsum(self.SIZES)[:-1]
        e, c, cb, t, tb = np.split(weights, cut)
        self.embed = e.reshape(len(OFFSETS), VOCABULARY, WIDTH)
        self.classes, self.class_bias = c.reshape(WIDTH, CLASSES), cb
        self.tokens, self.token_bias = t.reshape(CLASSES, WIDTH, WITHIN), tb.reshape(CLASSES, WITHIN)
        self.room = None  # arrays that steps write to

    @classmethod
    def start(cls, seed: int = 17) -> np.ndarray:
        rng = np.random.default_rng(seed)
        w = rng.normal(0, 0.1, sum(cls.SIZES)).astype(np.float32)
        biases = np.zeros(sum(cls.SIZES), bool)
        a = sum(cls.SIZES[:2])
        biases[a : a + cls.SIZES[2]] = biases[-cls.SIZES[4] :] = True
        w[biases] = 0
        return w

    def hidden(self, rows: np.ndarray, out: np.ndarray | None = None) -> np.ndarray:
        """One row for each position; `rows` are those of its neighbours in all embeddings one below the other."""
        each = np.take(self.embed.reshape(-1, WIDTH), rows, axis=0, out=out, mode="clip")
        h = each[0]
        for other in each[1:]:
            h += other
        return np.tanh(h, out=h)

    def log_probabilities(self, around: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Of each target, given its neighbours (one row of `around` for each offset)."""
        order = np.argsort((target % CLASSES).astype(np.uint8), kind="stable")
        kind, place = target[order] % CLASSES, target[order] // CLASSES
        at = np.arange(len(target))
        h = self.hidden(around[:, order] + STARTS)
        z = self.classes.T @ h.T
        z += self.class_bias[:, None]
        found = z[kind, at]
        found -= _raised(z, 0)
        found -= np.log(z.sum(axis=0))
        y = np.empty((len(target), WITHIN), np.float32)
        cuts = np.searchsorted(kind, np.arange(CLASSES + 1))
        for c in range(CLASSES):
            own = y[cuts[c] : cuts[c + 1]]
            np.matmul(h[cuts[c] : cuts[c + 1]], self.tokens[c], out=own)
            own += self.token_bias[c]
        found += y[at, place]
        found -= _raised(y, 1)
        found -= np.log(y @ ONES[:WITHIN])
        out = np.empty_like(found)
        out[order] = found
        return out

    def learn(self, stream: np.ndarray, at: np.ndarray, rate: float) -> None:
        """SGD on the positions `at` of `stream`, in mini-batches in their order."""
        for first in range(0, len(at), SORTED * MINI):
            pick = at[first : first + SORTED * MINI]
            self._learn(stream[pick + OFFSETS[:, None]], stream[pick], rate, MINI)

    def step(self, around: np.ndarray, target: np.ndarray, rate: float) -> None:
        """One step of SGD on a mini-batch, one column for each position."""
        self._learn(around, target, rate, len(target))

    def _learn(self, around: np.ndarray, target: np.ndarray, rate: float, size: int) -> None:
        """Steps on mini-batches of `size` columns. Positions of a mini-batch are sorted by class and fill blocks of one
        class: its first block has the number of the class, blocks beyond that stand behind the last class."""
        n = len(target)
        key = np.arange(n) // size * CLASSES + target % CLASSES  # below CLASSES * SORTED
        order = np.argsort(key.astype(np.uint16), kind="stable")
        key, rows = key[order], around[:, order] + STARTS
        place, kind = np.divmod(target[order].astype(np.int64), CLASSES)
        cuts = np.searchsorted(key, np.arange(-(-n // size) * CLASSES + 1))
        more = np.maximum(np.diff(cuts) - 1, 0).reshape(-1, CLASSES) // BLOCK
        over, rest = np.divmod(np.arange(n) - cuts[key], BLOCK)
        block = np.where(over > 0, (CLASSES - 1 + np.cumsum(more, axis=1) - more).ravel()[key] + over, kind)
        spot = block * BLOCK + rest
        for i, begin in enumerate(range(0, n, size)):
            at = slice(begin, begin + size)
            self._step(np.ascontiguousarray(rows[:, at]), kind[at], place[at], spot[at], np.repeat(np.arange(CLASSES), more[i]), rate)

    def _step(self, rows: np.ndarray, kind: np.ndarray, place: np.ndarray, spot: np.ndarray, owner: np.ndarray, rate: float) -> None:
        """A step. Rates are of a mean over SCALE positions, so that frequent weights, which get the gradients of many
        positions at once, stay stable. All blocks (`spot`: places in them, `owner`: classes of those beyond the first) are
        one batched product; what is left of a block is zero."""
        n = len(kind)
        if self.room is None or len(self.room[0]) != n:
            self.room = (
                np.arange(n), np.empty((len(OFFSETS), n, WIDTH), np.float32), np.empty((CLASSES, n), np.float32),
                np.zeros((n + 1, WITHIN), np.float32), np.empty((n, WITHIN), np.float32), np.empty((n, WIDTH), np.float32),
                np.empty((n, WIDTH), np.float32), np.empty((len(OFFSETS), n, WIDTH // 2), np.int64),
            )
        at, each, p, padded, bias, back, part, cells = self.room
        fill = np.full((CLASSES + len(owner)) * BLOCK, n)
        fill[spot] = at

        h = self.hidden(rows, each)
        rate = np.float32(rate / SCALE)
        np.matmul(self.classes.T, h.T, out=p)
        p += self.class_bias[:, None]
        _raised(p, 0)
        p *= rate / p.sum(axis=0)
        p.reshape(-1)[kind * n + at] -= rate
        tokens = np.concatenate([self.tokens, self.tokens[owner]])
        inner = np.take(h, fill, axis=0, mode="clip").reshape(-1, BLOCK, WIDTH)
        z = inner @ tokens
        q = np.take(z.reshape(-1, WITHIN), spot, axis=0, out=padded[:n], mode="clip")
        q += np.take(self.token_bias, kind, axis=0, out=bias, mode="clip")
        _raised(q, 1)
        q *= (rate / (q @ ONES[:WITHIN]))[:, None]
        q.reshape(-1)[at * WITHIN + place] -= rate
        outer = np.take(padded, fill, axis=0, out=z.reshape(-1, WITHIN), mode="clip").reshape(z.shape)
        np.matmul(p.T, self.classes.T, out=back)
        back += np.take((outer @ tokens.transpose(0, 2, 1)).reshape(-1, WIDTH), spot, axis=0, out=part, mode="clip")
        moved, biases = inner.transpose(0, 2, 1) @ outer, ONES[:BLOCK] @ outer
        for i, c in enumerate(owner.tolist(), CLASSES):
            moved[c] += moved[i]
            biases[c] += biases[i]
        self.tokens -= moved[:CLASSES]
        self.token_bias -= biases[:CLASSES]
        self.classes -= (p @ h).T
        self.class_bias -= p.sum(axis=1)
        h *= h
        h -= 1
        back *= h
        np.take(CELLS, rows, axis=0, out=cells, mode="clip")
        own, pairs = self.embed.reshape(-1).view(np.complex64), back.reshape(-1).view(np.complex64)
        for own_cells in cells:
            np.add.at(own, own_cells.reshape(-1), pairs)


def _raised(z: np.ndarray, axis: int) -> np.ndarray | float:
    """exp in place of z, less a top for each slice along the axis, which is returned."""
    top: np.ndarray | float = 0.0
    if z.max(initial=0) > SAFE or z.min(initial=0) < -SAFE:
        top = z.max(axis=axis)
        z -= np.expand_dims(top, axis)
    np.exp(z, out=z)
    return top


def windows(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one stream, with PAD beyond the ends of each, and where their tokens stand in it."""
    gap = np.full(SIDE, PAD, np.int16)
    sizes = [len(t) for t in texts]
    stream = np.concatenate([gap, *(part for t in texts for part in (t, gap))]).astype(np.int64)
    return stream, np.arange(sum(sizes)) + np.repeat(SIDE * np.arange(1, len(sizes) + 1), sizes)


def coded(documents: DataFrame, known: dict[str, int], counts: DataFrame | None = None, chunks: DataFrame | None = None) -> DataFrame:
    """Every document once in numbers: doc_id, n_tokens, tokens (16 bits each) and within.

    `within` is the sum of log(n + 1) over its rare words, n being that of `counts` (by default of the documents themselves), in
    multiples of 1 / UNIT. `chunks` are the documents as `lexed` makes them.
    """
    chunks = lexed(documents) if chunks is None else chunks
    counts = counted(documents, chunks) if counts is None else counts
    spark = documents.sparkSession
    numbers = F.broadcast(spark.createDataFrame(list(known.items()), "word string, number int"))  # fixed size
    one = F.round(F.log(F.coalesce("n", F.lit(0)) + 1.0) * UNIT).cast("long")
    entries = chunks.filter("word IS NOT NULL").select("chunk", "id", "word", "bucket").join(numbers, "word", "left").join(counts.select("word", "n"), "word", "left")
    entries = entries.select("chunk", "id", F.coalesce("number", "bucket").alias("place"), F.when(F.col("number").isNull(), one).otherwise(0).alias("one"))

    def run(texts: pa.Table, entries: pa.Table) -> pa.Table:
        place, one = np.zeros(entries.num_rows, np.int16), np.zeros(entries.num_rows + 1, np.int64)
        ids = entries["id"].to_numpy()
        place[ids], one[ids] = entries["place"].to_numpy(), entries["one"].to_numpy()
        out: dict[str, list] = {"n_tokens": [], "tokens": [], "within": []}
        for data in texts["ids"].to_pylist():
            own = _unpacked(data)
            out["n_tokens"].append(len(own))
            out["tokens"].append(place[own].tobytes())
            out["within"].append(int(one[own].sum()))
        return pa.table([texts["doc_id"], pa.array(out["n_tokens"], pa.int64()), pa.array(out["tokens"], pa.binary()), pa.array(out["within"], pa.int64())], names=["doc_id", *out])

    texts = chunks.filter("word IS NULL").select(F.col("chunk").alias("own"), "doc_id", "ids")
    both = texts.groupBy("own").cogroup(entries.groupBy("chunk"))
    return stored(both.applyInArrow(run, "doc_id long, n_tokens long, tokens binary, within long"), "codes", compression="zstd")


def _numbers(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.int16)


def learn(documents: DataFrame, known: dict[str, int], codes: DataFrame | None = None) -> np.ndarray:
    """The averaged weights after ROUNDS rounds over every position of all documents; `codes` as `coded` makes them.

    Which positions a task trains on together depends on how the documents are dealt to tasks, and so do the weights, slightly.
    """
    codes = coded(documents, known) if codes is None else codes
    spark = documents.sparkSession
    weights = Network.start()
    for turn in range(ROUNDS):
        sent = spark.sparkContext.broadcast(weights)

        def run(batches: Iterator[pa.RecordBatch], sent=sent, turn=turn) -> Iterator[pa.RecordBatch]:
            begin = sent.value
            own = begin.copy()
            net, seen = Network(own), 0
            texts: list[np.ndarray] = []

            def train() -> int:
                stream, at = windows(texts)
                rng = np.random.default_rng(seen + turn)
                net.learn(stream, at[rng.permutation(len(at))], RATE / (1 + turn))
                texts.clear()
                return len(at)

            held = 0
            for batch in batches:
                for part in pieces(batch):
                    for data in part.column(0).to_pylist():
                        if data:
                            texts.append(_numbers(data))
                            held += len(texts[-1])
                        if held >= 1 << 16:
                            seen += train()
                            held = 0
                        if seen >= PART:
                            yield _rows(own, seen)
                            own[:] = begin
                            seen = 0
            if held:
                seen += train()
            if seen:
                yield _rows(own, seen)

        sums = codes.select("tokens").mapInArrow(run, "place int, value double, n double").groupBy("place")
        sums = sums.agg(F.sum("value").alias("value"), F.sum("n").alias("n"))
        new = np.zeros(len(weights))
        for row in sums.toLocalIterator():  # as many rows as the network has weights
            new[row["place"]] = row["value"] / row["n"]
        if new.any():
            weights = new.astype(np.float32)
        sent.unpersist()
    return weights


def _rows(weights: np.ndarray, seen: int) -> pa.RecordBatch:
    n = np.full(len(weights), float(seen))
    cols = [pa.array(np.arange(len(weights), dtype=np.int32)), pa.array(weights * n), pa.array(n)]
    return pa.RecordBatch.from_arrays(cols, names=["place", "value", "n"])


def score(
    documents: DataFrame, known: dict[str, int], weights: np.ndarray, counts: DataFrame | None = None, codes: DataFrame | None = None
) -> DataFrame:
    """doc_id, n_tokens, log_likelihood (the sum over all tokens) and mean of every row.

    A null or empty text, or one without a token, has no tokens, the sum 0 and a null mean. Equal texts have
    equal scores. A rare word counts with log p(bucket | neighbours) + log p(word | bucket); of the latter the
    counts (by default those of the documents themselves) are raised by one, and one more is kept for words
    that they do not have. `codes` are the documents as `coded` makes them with the same counts.
    """
    chunks = lexed(documents) if counts is None and codes is None else None
    counts = counted(documents, chunks) if counts is None else counts
    codes = coded(documents, known, counts, chunks) if codes is None else codes
    rare = counts.filter(~F.col("word").isin(list(known))) if known else counts
    totals = np.zeros(VOCABULARY)
    for r in rare.groupBy("bucket").agg((F.sum("n") + F.count("*") + 1).alias("total")).collect():  # HASHED rows at most
        totals[r["bucket"]] = np.log(r["total"])
    sent = documents.sparkSession.sparkContext.broadcast((weights, totals))  # fixed size

    def start():
        own, totals = sent.value
        net = Network(own)

        def rows(at):
            tokens = [_numbers(t) for t in at["tokens"]]
            sizes = np.array([len(t) for t in tokens])
            sums = np.zeros(len(tokens))
            if sizes.sum():
                stream, place = windows(tokens)
                cuts = [place[i : i + CUT] for i in range(0, len(place), CUT)]
                logs = [net.log_probabilities(stream[c + OFFSETS[:, None]], stream[c]) for c in cuts]
                full = sizes > 0
                begins = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
                sums[full] = np.add.reduceat(np.concatenate(logs).astype(np.float64) - totals[stream[place]], begins)
            sums += np.array(at["within"], np.int64) / UNIT
            mean = [s / n if n else None for s, n in zip(sums.tolist(), sizes.tolist())]
            return {"doc_id": at["doc_id"], "n_tokens": sizes, "log_likelihood": sums, "mean": mean}

        return rows

    return map_columns(codes.select("doc_id", "tokens", "within"), "doc_id long, n_tokens long, log_likelihood double, mean double", start)

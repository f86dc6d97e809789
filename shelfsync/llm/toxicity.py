"""Toxicity by compression distance: two zstandard dictionaries, one per class.

Texts are cut at white space into windows. Each window is compressed with the dictionary of toxic text and
with the dictionary of ordinary text; the difference of the two lengths says which text it is more like.
The differences of a document's windows are summed up and mapped to a probability by a logistic curve
fitted on labelled texts that the dictionaries were not trained on.

What a class dictionary is trained on: the passages of that class that the other class lacks (byte groups
found by their document frequency in both), since most of a toxic text reads like any other.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import zstandard as zstd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import map_columns, remainder

#: Labelled texts of each class that training takes at most, chosen by a hash of the id and text.
SAMPLE = 2000
#: Characters of sampled text per class at most; texts are taken whole.
SAMPLE_CHARS = 8_000_000
#: Sizes of windows; each is measured on its own.
WINDOWS = (256, 640)
#: How much worse a toxic text missed is than an ordinary one turned away.
COST = 3.0
GRAM = 5
SPAN = 40
DICTIONARY = 4096
MATCH = 5
STRATEGY = zstd.STRATEGY_LAZY2
#: How many times rarer a passage of toxic text has to be in ordinary text.
LIFT = 40
#: Shares of the toxic texts that a passage has to occur in; calibration chooses one.
SHARES = (0.008, 0.016, 0.03, 0.05, 0.08)


def _grams(data: bytes) -> np.ndarray:
    """Every group of GRAM bytes as a number."""
    a = np.frombuffer(data, dtype=np.uint8).astype(np.uint64)
    n = len(a) - GRAM + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(GRAM):
        out = (out << np.uint64(8)) | a[i : n + i]
    return out


def _unlike(docs: list[bytes]) -> list[bytes]:
    """Without near copies of earlier texts, which would count one passage many times.

    A text is dropped if two of four smallest hashes of its passages of SPAN bytes were met before.
    """
    factors = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)
    seen: set[tuple[int, int]] = set()
    out = []
    for doc in docs:
        g = _grams(doc + b" " * SPAN)
        n = len(g) - SPAN + GRAM
        span = np.zeros(n, np.uint64)
        for at in range(0, SPAN, GRAM):
            span = (span ^ (span >> np.uint64(29))) * factors[0] + g[at : n + at]
        marks = {(i, int(((span * f) >> np.uint64(20)).min())) for i, f in enumerate(factors)}
        if len(marks & seen) < 2:
            out.append(doc)
        seen |= marks
    return out


def _frequencies(docs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    if not docs:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.unique(np.concatenate([np.unique(_grams(d)) for d in docs]), return_counts=True)


def _peculiar(own, other, n_own: int, n_other: int, lift: float, share: float) -> np.ndarray:
    """Byte groups that are common enough in one class and `lift` times rarer in the other."""
    groups, counts = own
    elsewhere = np.zeros(len(groups))
    if len(other[0]) and len(groups):
        at = np.minimum(np.searchsorted(other[0], groups), len(other[0]) - 1)
        elsewhere = np.where(other[0][at] == groups, other[1][at], 0)
    ratio = (counts / max(n_own, 1)) / ((elsewhere + 0.5) / max(n_other, 1))
    return np.sort(groups[(counts >= max(4, share * n_own)) & (ratio >= lift)])


def _passages(data: bytes, groups: np.ndarray) -> list[bytes]:
    """What the given byte groups cover of a text, as words or beginnings of words with the space before them."""
    g = _grams(data)
    if not len(g) or not len(groups):
        return []
    hit = groups[np.minimum(np.searchsorted(groups, g), len(groups) - 1)] == g
    cover = np.zeros(len(data) + 2, np.int8)
    at = np.flatnonzero(hit)
    for i in range(GRAM):
        cover[at + i + 1] = 1
    edges = np.diff(cover)
    runs = (data[a:b] for a, b in zip(np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)))
    heads = (b" " + w for run in runs for w in run[re.search(rb"^\S*", run).end() :].split())
    return [w for w in heads if len(w) >= GRAM]


def _dictionary(samples: list[bytes]) -> bytes:
    """The most frequent passages, each once, the most frequent last, where zstandard refers to it most cheaply.

    Zero bytes part them, so that no match runs over two passages.
    """
    chosen: list[bytes] = []
    left = DICTIONARY
    for passage, _ in Counter(samples).most_common():
        if left < len(passage):
            break
        if not any(passage in other for other in chosen):
            chosen.append(passage)
            left -= len(passage) + 1
    return b"\0".join(reversed(chosen)) or b"\0" * MATCH


def train(toxic: list[bytes], ordinary: list[bytes]) -> list[tuple[bytes, bytes]]:
    """The dictionaries of toxic and of ordinary text, a pair for each of SHARES."""
    toxic, ordinary = _unlike(toxic), _unlike(ordinary)
    t, o = _frequencies(toxic), _frequencies(ordinary)
    good = _peculiar(o, t, len(ordinary), len(toxic), 3, SHARES[0])
    usual = [p for d in ordinary for p in _passages(d, good)] or [w for d in ordinary for w in re.findall(rb"\S+\s*", d)]
    out = []
    for share in SHARES:
        bad = _peculiar(t, o, len(toxic), len(ordinary), LIFT, share)
        first, second = _dictionary([p for d in toxic for p in _passages(d, bad)]), _dictionary(usual)
        second = second[-len(first) :].rjust(len(first), b"\0")  # a longer dictionary would find more matches by chance
        out.append((first, second))
    return out


def windows(data: bytes, size: int) -> np.ndarray:
    """Start and length of the windows: cut at the first white space after every `size` bytes."""
    if not data:
        return np.zeros((0, 2), np.uint64)
    a = np.frombuffer(data, dtype=np.uint8)
    ends = np.append(np.flatnonzero(a <= 32) + 1, len(a))
    at = np.minimum(np.searchsorted(ends, np.arange(size, len(a) + size, size)), len(ends) - 1)
    cuts = np.unique(np.concatenate([[0], ends[at]]))
    return np.stack([cuts[:-1], np.diff(cuts)], axis=1).astype(np.uint64)


class Lengths:
    """Compressed lengths of windows under one dictionary.

    Both dictionaries are raw content of the same length, so lengths differ by what their matches save alone.
    """

    def __init__(self, content: bytes):
        made = zstd.ZstdCompressionDict(content, dict_type=zstd.DICT_TYPE_RAWCONTENT)
        how = zstd.ZstdCompressionParameters(
            window_log=12, hash_log=13, chain_log=12, search_log=1, min_match=MATCH, target_length=1,
            strategy=STRATEGY, write_content_size=False, write_dict_id=False, write_checksum=False,
            format=zstd.FORMAT_ZSTD1_MAGICLESS,
        )
        made.precompute_compress(compression_params=how)
        self.coder = zstd.ZstdCompressor(dict_data=made, compression_params=how)

    def of(self, data: bytes, cuts: np.ndarray) -> np.ndarray:
        out = self.coder.multi_compress_to_buffer(zstd.BufferWithSegments(data, cuts.tobytes()), threads=1)
        return np.fromiter(map(len, out), dtype=np.int64, count=len(cuts))


def measured(texts: list[bytes], dictionaries: tuple[bytes, bytes]) -> np.ndarray:
    """Per text and size of windows: their number, the bytes that the toxic dictionary saves over the ordinary one, and
    those of the windows that gain."""
    toxic, ordinary = map(Lengths, dictionaries)
    out = np.zeros((len(texts), len(WINDOWS), 3))
    for k, data in enumerate(texts):
        for j, size in enumerate(WINDOWS):
            cuts = windows(data, size)
            if len(cuts):
                saved = ordinary.of(data, cuts) - toxic.of(data, cuts)
                out[k, j] = len(cuts), saved.sum(), saved[saved > 0].sum()
    return out


def usual_savings(sums: np.ndarray) -> np.ndarray:
    """What a window of the given texts saves on average, by its size."""
    total = sums.sum(axis=0)
    return total[:, 1:] / np.maximum(total[:, :1], 1)


def features(sums: np.ndarray, usual: np.ndarray) -> np.ndarray:
    """What the curve takes: savings as means, and their excess over what as many windows of ordinary text save,
    in units that do not grow with the length of a text."""
    n = np.maximum(sums[:, :, :1], 1)
    excess = (sums[:, :, 1:] - sums[:, :, :1] * usual) / np.sqrt(n)
    flat = (len(sums), -1)
    return np.column_stack([np.ones(len(sums)), excess.reshape(flat), (sums[:, :, 1:] / n).reshape(flat)])


class Model:
    """Dictionaries, savings of a window of ordinary text, and the calibrated curve."""

    def __init__(self, dictionaries: tuple[bytes, bytes], usual: np.ndarray, weights: np.ndarray):
        self.dictionaries, self.usual, self.weights = dictionaries, usual, weights

    def scores(self, texts: list[bytes]) -> np.ndarray:
        return _curve(features(measured(texts, self.dictionaries), self.usual), self.weights)


def _curve(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Weights of the curve; `counts`: how many labelled texts each one stands for."""
    w = np.zeros(x.shape[1])
    keep = 1e-1 * np.eye(x.shape[1])
    for _ in range(40):
        p = _curve(x, w)
        w += np.linalg.solve((x * (counts * p * (1 - p))[:, None]).T @ x + keep, x.T @ (counts * (y - p)) - keep @ w)
    return w


def fit(texts: list[bytes], toxic: list[int], ratio: float = 1.0) -> Model:
    """Train on labelled texts; `ratio`: for how many texts each ordinary one stands, if each toxic one is one.

    With one class only, or none, every text scores by the share of toxic ones; so it does if too
    few toxic texts are known for any passage to stand out.
    """
    bad = [t for t, y in zip(texts, toxic) if y]
    good = [t for t, y in zip(texts, toxic) if not y]
    if not bad or not good:
        share = 1e-6 if not bad else 1 - 1e-6
        return Model((b" " * MATCH,) * 2, np.zeros((len(WINDOWS), 2)), np.array([np.log(share / (1 - share))] + [0.0] * 4 * len(WINDOWS)))
    # one half trains the dictionaries, the other, unseen by them, chooses among them and fits the curve
    texts = bad[1::2] + good[1::2]
    marks = np.array([1.0] * len(bad[1::2]) + [0.0] * len(good[1::2]))
    share = len(bad) / (len(bad) + ratio * len(good))
    nothing = np.tile(np.array([1.0, 0.0, 0.0]), (1, len(WINDOWS), 1))
    best = None
    for pair in train(bad[::2], good[::2]):
        sums = measured(texts, pair)
        usual = usual_savings(sums[marks == 0])
        x = features(sums, usual)
        counts = np.where(marks == 1, COST, ratio)
        w = _logistic(x, marks, counts)
        if _curve(features(nothing, usual), w)[0] > share:  # too little to go by: no text may seem toxic for its cost alone
            w = _logistic(x, marks, np.where(marks == 1, 1.0, ratio))
        p = np.clip(_curve(x, w), 1e-6, 1 - 1e-6)
        loss = -(counts * (marks * np.log(p) + (1 - marks) * np.log(1 - p))).sum() / counts.sum()
        if best is None or loss < best[0]:
            best = loss, Model(pair, usual, w)
    return best[1]


def sample(documents: DataFrame, labels: DataFrame) -> tuple[list[bytes], list[int], float]:
    """At most SAMPLE texts of each class and SAMPLE_CHARS characters, in the order of a hash of the ids; and
    for how many more labels an ordinary text stands than a toxic one.

    The ids are chosen first and, being few, broadcast, so that no text is shuffled.
    """
    order = F.xxhash64(F.lit(7), F.col("doc_id"))
    sizes = {r["toxic"]: r["n"] for r in labels.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    texts, marks = [], []
    for mark in (0, 1):
        chosen = labels.filter(F.col("toxic") == mark).select("doc_id", order.alias("place")).orderBy("place", "doc_id").limit(SAMPLE)
        rows = documents.select("doc_id", "text").filter("text <> ''").join(F.broadcast(chosen), "doc_id").select("place", "text")
        left = SAMPLE_CHARS
        for row in rows.orderBy("place", "text").limit(SAMPLE).toLocalIterator():
            left -= len(row["text"])
            if left < 0 and texts and marks[-1] == mark:
                break
            texts.append(row["text"].encode("utf-8", "replace"))
            marks.append(mark)
    share = [sizes.get(m, 0) / max(marks.count(m), 1) for m in (0, 1)]
    return texts, marks, (share[0] / share[1] if share[1] else 1.0)


def learn(documents: DataFrame, labels: DataFrame, fold: int = 4, held: int = 2) -> Model:
    """Fit on labelled documents outside the held-out fold. Rows without id, text or label teach nothing."""
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter("doc_id IS NOT NULL AND toxic IN (0, 1)")
    return fit(*sample(documents, known.filter(remainder(F.col("doc_id"), fold) != held).distinct()))


def score(documents: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """doc_id, score and predicted of every row. Null and empty texts score as a text without any evidence."""
    sent = documents.sparkSession.sparkContext.broadcast(model)  # a few kilobytes, whatever the data

    def start():
        ready = sent.value

        def rows(at):
            found = ready.scores([(t or "").encode("utf-8", "replace") for t in at["text"]])
            return {"doc_id": at["doc_id"], "score": found, "predicted": (found >= threshold).astype(np.int32)}

        return rows

    return map_columns(documents.select(F.col("doc_id").cast("long"), "text"), "doc_id long, score double, predicted int", start)


def keep_clean(documents: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """The rows whose score stays below the threshold, all their columns unchanged."""
    sent = documents.sparkSession.sparkContext.broadcast(model)

    def start():
        ready = sent.value

        def rows(at):
            found = ready.scores([(t or "").encode("utf-8", "replace") for t in at["text"]])
            return {n: [v for v, s in zip(values, found) if s < threshold] for n, values in at.items()}

        return rows

    return map_columns(documents, ", ".join(f"`{n}` {t}" for n, t in documents.dtypes), start)

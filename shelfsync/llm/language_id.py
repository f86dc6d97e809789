"""Language identification: averaged embeddings of hashed subwords and a linear softmax, trained by SGD.

Subwords are the groups of two, three and four bytes of the text in lower case, hashed to a fixed number of
rows of an embedding table. A text is the average of its rows; a softmax layer turns it into probabilities.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordering import keep_latest
from .batches import map_columns, remainder

BUCKETS = 1 << 14
WIDTH = 16
SIZES = (2, 3, 4)
#: Texts that training takes of each language at most, chosen by a hash of the row, and characters of them all.
SAMPLE = 1500
SAMPLE_CHARS = 16_000_000
EPOCHS = 6
RATE = 0.5
#: Share of correct held-back predictions that calibrated rejection may turn away.
REJECT = 0.01
UNKNOWN = "und"


def hashed(data: bytes) -> np.ndarray:
    """Row numbers of the subwords of a text."""
    a = np.frombuffer(data, dtype=np.uint8).astype(np.uint32)
    out, code = [], a
    for size in range(2, max(SIZES) + 1):
        if len(a) < size:
            break
        code = code[:-1] * np.uint32(0x01000193) + a[size - 1 :] * np.uint32(0x9E3779B1) + np.uint32(size)
        if size in SIZES:
            mixed = code ^ (code >> np.uint32(15))
            out.append((mixed * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BUCKETS.bit_length() + 1))
    return np.concatenate(out) if out else a[:0]


def prepared(text: str) -> bytes:
    return text.lower().encode("utf-8", "replace")


def has_letter(text: str | None) -> bool:
    return bool(text) and any(c.isalpha() for c in text)


class Model:
    def __init__(self, languages: list[str], table: np.ndarray, threshold: float):
        self.languages, self.table, self.threshold = languages, table, threshold

    def probabilities(self, data: bytes) -> np.ndarray:
        """`table` is embeddings times softmax weights: their average is the layer's input."""
        rows = hashed(data)
        z = self.table[rows].mean(axis=0) if len(rows) else np.zeros(len(self.languages))
        e = np.exp(z - z.max())
        return e / e.sum()


def _bags(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Row numbers with their shares."""
    out = []
    for t in texts:
        rows, n = np.unique(hashed(t), return_counts=True)
        out.append((rows, (n / max(n.sum(), 1)).astype(np.float32)))
    return out


def fit(texts: list[str], langs: list[str], seed: int = 5) -> Model | None:
    """Train, holding every eighth text back to calibrate rejection. None if there is nothing to learn from."""
    languages = sorted(set(langs))
    if not languages:
        return None
    y = np.array([languages.index(x) for x in langs])
    bags = _bags([prepared(t) for t in texts])
    rng = np.random.default_rng(seed)
    embed = ((rng.random((BUCKETS, WIDTH)) - 0.5) / WIDTH).astype(np.float32)
    out = np.zeros((WIDTH, len(languages)), np.float32)
    kept = [i for i in range(len(bags)) if i % 8 != 7] or list(range(len(bags)))
    weight = len(y) / (len(languages) * np.maximum(np.bincount(y, minlength=len(languages)), 1))
    steps = EPOCHS * len(kept)
    done = 0
    for _ in range(EPOCHS):
        for i in rng.permutation(kept):
            rows, share = bags[i]
            if not len(rows):
                continue
            rate = RATE * (1 - done / steps)
            done += 1
            h = share @ embed[rows]
            z = h @ out
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[i]] -= 1
            p *= min(float(weight[y[i]]), 3.0)
            back = out @ p
            out -= rate * np.outer(h, p)
            embed[rows] -= np.outer(rate * share * len(rows) ** 0.5, back)
    model = Model(languages, (embed @ out).astype(np.float32), 0.0)
    held = [i for i in range(len(texts)) if i % 8 == 7]
    sure = [p[y[i]] for i in held if (p := model.probabilities(prepared(texts[i]))).argmax() == y[i]]
    model.threshold = float(np.quantile(sure, REJECT)) if sure else 0.0
    return model


def _sample(known: DataFrame, languages: int) -> DataFrame:
    """text, lang and times of the texts to learn from: the first SAMPLE of each language in the order of a hash, and no more
    of them than an equal share of SAMPLE_CHARS holds, but one.

    They are chosen by hash and length; only the chosen ones' texts leave their tasks.
    """
    keyed = known.withColumn("place", F.xxhash64(F.lit(11), F.col("doc_id"), F.col("text")))
    narrow = keyed.select("lang", "place", F.char_length("text").alias("size"))
    narrow = keep_latest(narrow, ["lang"], ["place"], SAMPLE, spread=["place"])  # cut in parts of a language first
    order = Window.partitionBy("lang").orderBy("place")
    narrow = narrow.withColumn("rank", F.row_number().over(order))
    narrow = narrow.withColumn("sum", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    chosen = narrow.filter((F.col("rank") == 1) | (F.col("sum") <= SAMPLE_CHARS // max(1, languages)))
    chosen = chosen.groupBy("lang", "place").agg(F.count("*").alias("times"))
    texts = keyed.join(chosen, ["lang", "place"]).select("lang", "place", "text", "times").dropDuplicates(["lang", "place"])
    return texts.orderBy("lang", "place").select("text", "lang", "times")


def learn(documents: DataFrame, fold: int = 3, held: int = 1) -> Model | None:
    """Fit on rows outside the held-out fold with text and language; others teach nothing."""
    known = documents.select("doc_id", "text", "lang").filter("lang IS NOT NULL AND text <> '' AND doc_id IS NOT NULL")
    known = known.filter(remainder(F.col("doc_id"), fold) != held)
    rows = _sample(known, known.select("lang").distinct().count())
    found = [(r["text"], r["lang"]) for r in rows.collect() for _ in range(r["times"])]  # SAMPLE_CHARS, and a text of each language
    texts, marks = [t for t, _ in found], [m for _, m in found]
    order = np.random.default_rng(3).permutation(len(texts))
    return fit([texts[i] for i in order], [marks[i] for i in order])


def predict(documents: DataFrame, model: Model | None) -> DataFrame:
    """Every row's doc_id, lang_pred, score and accepted.

    A null text, or one without letters, is `und` with score 0; so is every text if nothing could be learnt.
    `accepted` is false where the probability is below the calibrated threshold.
    """
    sent = documents.sparkSession.sparkContext.broadcast(model)  # BUCKETS rows, whatever the data

    def start():
        ready = sent.value

        def rows(at):
            names, scores = [], []
            for text in at["text"]:
                if ready is None or not has_letter(text):
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                p = ready.probabilities(prepared(text))
                names.append(ready.languages[int(p.argmax())])
                scores.append(float(p.max()))
            sure = [ready is not None and n != UNKNOWN and s >= ready.threshold for n, s in zip(names, scores)]
            return {"doc_id": at["doc_id"], "lang_pred": names, "score": scores, "accepted": sure}

        return rows

    kind = "doc_id long, lang_pred string, score double, accepted boolean"
    return map_columns(documents.select(F.col("doc_id").cast("long"), "text"), kind, start)

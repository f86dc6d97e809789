"""Results of registered queries against plain Python over the same rows."""

import hashlib
import re
from zlib import crc32

import duckdb
import numpy as np
import pytest

from shelfsync.llm import masked_lm
from shelfsync.llm.queries import QUERIES

ROOT = "/root/testdata/sf0.001"
SF1 = "/root/testdata/sf0.01"


def table(root, name, columns):
    return duckdb.sql(f"SELECT {columns} FROM '{root}/{name}.parquet'").fetchall()


def remainder(doc_id, by):
    return crc32(str(doc_id).encode()) % by


def test_secrets_base_spans(spark):
    assign = re.compile("(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
    kinds = ["assign", "access", "hex"]
    wanted = {}
    for doc_id, text in table(ROOT, "documents", "doc_id, text"):
        found = [("assign", m.start(), m.end()) for m in assign.finditer(text or "") if len(m[2]) >= 6]
        found += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text or "") if len(m[0]) >= 20]
        found += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text or "") if len(m[0]) >= 24]
        found.sort(key=lambda s: (s[1], kinds.index(s[0])))
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in found)
        wanted[doc_id] = (*(sum(f[0] == k for f in found) for k in kinds), hashlib.sha256(joined.encode()).hexdigest(), set(joined.split(",")) - {""})
    rows = QUERIES["op9_secrets"](spark, ROOT).collect()
    assert len(rows) == len(wanted)
    for r in rows:
        own = wanted[r["doc_id"]]
        assert (r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"]) == own[:4]
        assert own[4] <= set((r["spans"] or "").split(","))


def test_toxicity_columns_and_held_out_rows(spark):
    rows = {r["doc_id"]: r for r in QUERIES["op3_toxicity"](spark, SF1).collect()}
    ids = [i for (i,) in table(SF1, "documents", "doc_id")]
    assert sorted(rows) == sorted(ids)
    for i, r in rows.items():
        assert r["held_out"] == (remainder(i, 4) == 2) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    held = [(rows[i]["predicted"], t) for i, t in table(SF1, "labels", "doc_id, toxic") if i in rows and t is not None and rows[i]["held_out"]]
    assert len(held) > 50 and np.mean([p == t for p, t in held]) > 0.8  # some hundred labels to learn from


def test_language_columns_and_held_out_rows(spark):
    documents = table(SF1, "documents", "doc_id, text, lang")
    rows = {r["doc_id"]: r for r in QUERIES["op7_language"](spark, SF1).collect()}
    learned = {lang for i, text, lang in documents if text and lang and remainder(i, 3) != 1}
    right = []
    for i, text, lang in documents:
        r = rows[i]
        letters = any(c.isalpha() for c in text or "")
        assert r["held_out"] == (remainder(i, 3) == 1) and 0 <= r["score"] <= 1
        assert r["lang_pred"] in learned if letters else r["lang_pred"] == "und"
        if r["held_out"] and lang and letters:
            right.append(r["lang_pred"] == lang)
    assert len(right) > 100 and np.mean(right) > 0.95


@pytest.mark.parametrize("mini", [7, 64])
def test_a_training_step_is_the_gradient(mini):
    """A step against sums over single positions, without sorting, padding or batches."""
    rng = np.random.default_rng(mini)
    m = masked_lm
    start = (m.Network.start() + rng.normal(0, 0.2, sum(m.Network.SIZES))).astype(np.float32)
    around = rng.integers(0, m.VOCABULARY, (len(m.OFFSETS), mini)).astype(np.int32)
    around[:, : mini // 2] = around[:, :1]  # repeated neighbours
    target = np.where(rng.random(mini) < 0.5, 33, rng.integers(0, m.VOCABULARY, mini)).astype(np.int32)
    own = start.copy()
    m.Network(own).step(around, target, 0.5)
    net, wanted = m.Network(start), start.astype(np.float64)
    out = m.Network(wanted)
    for i in range(mini):
        h = np.tanh(sum(net.embed[k][around[k, i]] for k in range(len(m.OFFSETS))).astype(np.float64))
        c, w = target[i] % m.CLASSES, target[i] // m.CLASSES
        p = np.exp(h @ net.classes + net.class_bias)
        q = np.exp(h @ net.tokens[c] + net.token_bias[c])
        p, q = p / p.sum(), q / q.sum()
        p[c] -= 1
        q[w] -= 1
        rate = 0.5 / m.SCALE
        back = net.classes @ p + net.tokens[c] @ q
        out.classes -= rate * np.outer(h, p)
        out.class_bias -= rate * p
        out.tokens[c] -= rate * np.outer(h, q)
        out.token_bias[c] -= rate * q
        for k in range(len(m.OFFSETS)):
            out.embed[k][around[k, i]] -= rate * back * (1 - h * h)
    assert np.abs(own - wanted).max() < 1e-4


def test_scores_of_documents_one_token_at_a_time(spark):
    m = masked_lm
    texts = ["a b c d a b rare1 c", "a a a", "zz9 b c", "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    counts = m.counted(docs)
    known = {"a": 1, "b": 2, "c": 3}
    rng = np.random.default_rng(2)
    weights = (m.Network.start() + rng.normal(0, 0.3, sum(m.Network.SIZES))).astype(np.float32)
    net, n = m.Network(weights), {r["word"]: r["n"] for r in counts.collect()}
    rows = {r["doc_id"]: r for r in m.score(docs, known, weights, counts).collect()}
    for i, text in enumerate(texts):
        words, total = m.words(text), 0.0
        ids = [m.PAD] * m.SIDE + [known.get(w, m.bucket(w)) for w in words] + [m.PAD] * m.SIDE
        for at, word in enumerate(words):
            t = ids[at + m.SIDE]
            h = np.tanh(sum(net.embed[k][ids[at + m.SIDE + o]] for k, o in enumerate(m.OFFSETS)))
            z, y = h @ net.classes + net.class_bias, h @ net.tokens[t % m.CLASSES] + net.token_bias[t % m.CLASSES]
            total += z[t % m.CLASSES] - np.log(np.exp(z).sum()) + y[t // m.CLASSES] - np.log(np.exp(y).sum())
            if word not in known:
                others = {w: k for w, k in n.items() if w not in known and m.bucket(w) == m.bucket(word)}
                total += np.log(n[word] + 1) - np.log(sum(others.values()) + len(others) + 1)
        assert rows[i]["n_tokens"] == len(words) and abs(rows[i]["log_likelihood"] - total) < 1e-3
        assert (rows[i]["mean"] is None) == (not words)

"""Trained models: toxicity, masked likelihood, language."""

import random

import numpy as np
from pyspark.sql import functions as F

from shelfsync.llm import language_id, masked_lm, toxicity

SYLLABLES = "ba do ke lu mi no pra sti tre vo wha zen ing ion al er".split()
KIND = "doc_id long, text string, lang string, source string, n_chars long"


def prose(draw, n):
    return " ".join("".join(draw.choice(SYLLABLES) for _ in range(draw.randint(1, 4))) for _ in range(n))


def labelled(n=700):
    draw = random.Random(4)
    texts, marks = [], []
    for i in range(n):
        words = prose(draw, draw.randint(60, 300)).split()
        if i % 4 == 0:
            for _ in range(3 + len(words) // 25):
                words.insert(draw.randrange(len(words)), draw.choice(("nastyword", "horridone", "vilething")))
        texts.append(" ".join(words))
        marks.append(int(i % 4 == 0))
    return texts, marks


def test_toxic_texts_are_told_apart_on_held_out_rows(spark):
    texts, marks = labelled()
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)] + [(None, None, None, None, None), (9001, "", "en", "s", 0), (9002, prose(random.Random(1), 30_000), "en", "s", 1)]
    docs = spark.createDataFrame(rows, KIND).withColumn("score", F.lit("clash")).withColumn("toxic", F.lit("clash"))
    labels = spark.createDataFrame([(i, 1, m) for i, m in enumerate(marks)] + [(None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")
    model = toxicity.learn(docs, labels)
    got = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got.values())
    held = docs.select("doc_id").filter(toxicity.remainder(F.col("doc_id"), 4) == 2).filter("doc_id < 9000").collect()
    right = [got[r[0]]["predicted"] == marks[r[0]] for r in held]
    assert len(right) > 100 and np.mean(right) > 0.95
    assert got[9001]["score"] == got[None]["score"] and not got[9002]["predicted"]
    assert toxicity.score(docs.limit(0), model).count() == 0
    clean = toxicity.keep_clean(docs, model)
    assert clean.columns == docs.columns and {r[0] for r in clean.select("doc_id").collect()} == {i for i, r in got.items() if r["score"] < 0.3}


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b c", "en", "s", 5)], KIND)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.score(docs, toxicity.learn(docs, labels)).first()["predicted"] == 0


def test_windows_cover_the_text():
    data = prose(random.Random(2), 4000).encode() + b"x" * 2000
    cuts = toxicity.windows(data, 256)
    assert b"".join(data[int(a) : int(a + n)] for a, n in cuts) == data


def test_masked_probabilities_sum_to_one():
    rng = np.random.default_rng(1)
    net = masked_lm.Network(masked_lm.Network.start() + rng.normal(0, 0.3, sum(masked_lm.Network.SIZES)).astype(np.float32))
    around = rng.integers(0, masked_lm.VOCABULARY, (len(masked_lm.OFFSETS), 1), dtype=np.int32)
    every = np.arange(masked_lm.VOCABULARY, dtype=np.int32)
    logs = net.log_probabilities(np.repeat(around, len(every), axis=1), every)
    assert abs(np.exp(logs).sum() - 1) < 1e-3
    h = np.tanh(sum(net.embed[k][around[k, 0]] for k in range(len(masked_lm.OFFSETS))))
    for t in (0, 77, 1023):  # one by one, without the grouping by class
        c, w = t % masked_lm.CLASSES, t // masked_lm.CLASSES
        z, y = h @ net.classes + net.class_bias, h @ net.tokens[c] + net.token_bias[c]
        want = z[c] - np.log(np.exp(z).sum()) + y[w] - np.log(np.exp(y).sum())
        assert abs(want - logs[t]) < 1e-4


def test_masked_likelihood_prefers_the_corpus(spark):
    draw = random.Random(8)
    line = "one two three four five six seven eight".split()
    texts = [" ".join(line * draw.randint(20, 60)) for _ in range(150)]
    shuffled = " ".join(draw.sample(line * 30, 240))
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)] + [(900, shuffled, "en", "s", 1), (901, " ".join(line * 30), "en", "s", 1), (902, None, None, None, None), (903, "", "en", "s", 0), (904, " \n", "en", "s", 0)]
    docs = spark.createDataFrame(rows, KIND).withColumn("word", F.lit(1)).withColumn("mean", F.lit(1))
    known = masked_lm.vocabulary(docs)
    assert set(known) == set(line)
    got = {r["doc_id"]: r for r in masked_lm.score(docs, known, masked_lm.learn(docs, known)).collect()}
    assert got[901]["mean"] > got[900]["mean"] + 0.5 and got[901]["mean"] > -2.5
    assert abs(got[901]["log_likelihood"] / got[901]["n_tokens"] - got[901]["mean"]) < 1e-9
    for i in (902, 903, 904):
        assert (got[i]["n_tokens"], got[i]["log_likelihood"], got[i]["mean"]) == (0, 0.0, None)
    empty = docs.limit(0)
    assert masked_lm.vocabulary(empty) == {} and masked_lm.score(empty, {}, masked_lm.learn(empty, {})).count() == 0


def test_masked_training_sees_every_position(spark):
    line = [f"w{i:03d}" for i in range(600)]  # each word once: its embedding moves only if its neighbour is trained on
    docs = spark.createDataFrame([(1, " ".join(line), "en", "s", 1)], KIND)
    known = masked_lm.vocabulary(docs)
    start, got = masked_lm.Network(masked_lm.Network.start()), masked_lm.Network(masked_lm.learn(docs, known))
    own = [known[w] for w in line[2:-2]]
    moved = np.abs(got.embed - start.embed).max(axis=2) > 0
    assert moved[:, own].all() and masked_lm.ROUNDS >= 2


def test_texts_are_cut_as_the_pattern_does():
    draw = random.Random(6)
    odd = [None, "", " ", "\n\n", "a", "Ab_1, c!!\x1c\x85d²½", "İ ΣΑΣ\nΑΣ", "漢字\u200bx\u0301 \U0001d518\U0001d52b\U0001f600é", "."]
    odd += ["".join(draw.choice("aÀß_9 .,\t\u2003漢\U0001f600\u0301") for _ in range(draw.randint(0, 40))) for _ in range(300)]
    for texts in (odd, odd[::-1], [None], [""], ["one"]):
        sizes, found = masked_lm.cut_up(texts)
        wanted = [masked_lm.words(t) for t in texts]
        assert sizes.tolist() == [len(w) for w in wanted] and found.to_pylist() == [w for own in wanted for w in own]


def test_chunks_hold_every_word_once(spark):
    texts = ["one two one", "", None, "two, three", "one " * 500] * 3
    docs = spark.createDataFrame([(i if i != 4 else None, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    chunks = masked_lm.lexed(docs).collect()
    words = {(r["chunk"], r["id"]): r["word"] for r in chunks if r["word"] is not None}
    assert len(set(words)) == len({(c, w) for (c, _), w in words.items()}) == sum(r["word"] is not None for r in chunks)
    found = [(r["doc_id"], [words[r["chunk"], i] for i in masked_lm._unpacked(r["ids"]).tolist()]) for r in chunks if r["word"] is None]
    wanted = [(i if i != 4 else None, masked_lm.words(t)) for i, t in enumerate(texts)]
    assert sorted(found, key=str) == sorted(wanted, key=str)
    n = {r["word"]: r["n"] for r in masked_lm.counted(docs).collect()}
    assert n == {"one": 1506, "two": 6, ",": 3, "three": 3}
    rows = masked_lm.coded(docs, {"one": 1}).collect()
    assert sorted(r["n_tokens"] for r in rows) == sorted(len(w) for _, w in wanted)
    rare = {w: round(np.log(k + 1) * masked_lm.UNIT) for w, k in n.items() if w != "one"}
    assert sorted(r["within"] for r in rows) == sorted(sum(rare.get(w, 0) for w in own) for _, own in wanted)


def test_masked_learning_is_one_step_after_another():
    m = masked_lm
    rng = np.random.default_rng(5)
    few = rng.integers(0, 3, 1500) * m.CLASSES + 7  # one class has far more positions than a block has rows
    stream, at = m.windows([few.astype(np.int16), np.zeros(0, np.int16), rng.integers(0, m.VOCABULARY, 1300).astype(np.int16)])
    assert len(at) == 2800 and (stream[at[:1500]] == few).all() and (stream[at[1499] + m.OFFSETS] == [few[-3], few[-2], m.PAD, m.PAD]).all()
    at = rng.permutation(at)
    own, wanted = m.Network.start(), m.Network.start()
    m.Network(own).learn(stream, at, 0.5)
    net = m.Network(wanted)
    for first in range(0, len(at), m.MINI):
        pick = at[first : first + m.MINI]
        net.step(stream[pick + m.OFFSETS[:, None]], stream[pick], 0.5)
    assert np.abs(own - wanted).max() < 1e-5 and np.isfinite(own).all()
    own *= 300  # logits beyond what exp takes
    m.Network(own).learn(stream, at, 0.5)
    assert np.isfinite(own).all() and np.isfinite(m.Network(own).log_probabilities(stream[at + m.OFFSETS[:, None]], stream[at])).all()


def test_rare_words_are_told_apart_within_their_bucket(spark):
    texts = ["lemon melon", *["lemon"] * 9, "lexon", "lemon lexon lemon", "lexon lexon lexon lexon"]  # one bucket: equal length and last letter
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], KIND)
    plain = masked_lm.Network.start()
    got = {r["doc_id"]: r for r in masked_lm.score(docs, {}, plain).collect()}
    n = {"lemon": 12, "lexon": 6, "melon": 1}
    assert {r["word"]: r["n"] for r in masked_lm.counted(docs).collect()} == n
    assert abs(got[1]["mean"] - got[10]["mean"] - np.log(13 / 7)) < 1e-6
    one = np.full((len(masked_lm.OFFSETS), 1), masked_lm.PAD), np.array([masked_lm.bucket("lemon")])
    in_bucket = float(masked_lm.Network(plain).log_probabilities(*one)[0])
    assert abs(got[1]["mean"] - in_bucket - np.log(13 / (sum(n.values()) + len(n) + 1))) < 1e-5
    assert len({got[i]["mean"] for i in range(1, 10)}) == 1
    more = spark.createDataFrame([(1, "lemon", "en", "s", 1), (2, "nixon", "en", "s", 1)], KIND)
    new = {r["doc_id"]: r["mean"] for r in masked_lm.score(more, {}, plain, masked_lm.counted(docs)).collect()}
    assert abs(new[1] - new[2] - np.log(13)) < 1e-6


def test_languages(spark):
    draw = random.Random(3)
    other = "scha tung keit ver ein ich heit pfa zu gen ber".split()
    def say(parts):
        return " ".join("".join(draw.choice(parts) for _ in range(draw.randint(1, 3))) for _ in range(draw.randint(20, 80)))
    rows = [(i, say(other if i % 3 == 0 else SYLLABLES), "de" if i % 3 == 0 else "en", "s", 1) for i in range(400)]
    odd = [(1000, None, None, None, None), (1001, "", "en", "s", 0), (1002, "123 -- 4!", "de", "s", 1), (None, say(other), None, None, 1), (1003, say(other) * 500, None, "s", 1)]
    docs = spark.createDataFrame(rows + odd, KIND).withColumn("lang_pred", F.lit("clash")).withColumn("accepted", F.lit(1))
    model = language_id.learn(docs)
    got = {r["doc_id"]: r for r in language_id.predict(docs, model).collect()}
    held = [r[0] for r in docs.select("doc_id").filter(language_id.remainder(F.col("doc_id"), 3) == 1).filter("doc_id < 1000").collect()]
    assert len(held) > 80 and np.mean([got[i]["lang_pred"] == rows[i][2] for i in held]) > 0.98
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (1000, 1001, 1002))
    assert got[None]["lang_pred"] == got[1003]["lang_pred"] == "de"
    none = language_id.predict(docs, language_id.learn(docs.limit(0)))
    assert {r["lang_pred"] for r in none.collect()} == {"und"} and language_id.predict(docs.limit(0), model).count() == 0

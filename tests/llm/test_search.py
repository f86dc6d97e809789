"""Search and matching: MaxScore, Wu-Manber, secrets, near duplicates, mixing."""

import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfsync.llm import decontamination, maxscore, mixing, near_duplicates, secret_scan
from shelfsync.llm.batches import uniform

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in texts], DOCS)


# --- MaxScore ------------------------------------------------------------------------------------------------


def brute_top(vectors, asked, k):
    whole = {}
    for i, x in vectors:
        if i is not None and x is not None and all(v is not None and math.isfinite(v) for v in x):
            whole.setdefault(i, []).append([math.floor(256 * float(v)) for v in x])
    out = []
    for q in asked:
        for own in whole.get(q, []):
            best = {}
            for i, many in whole.items():
                for x in many:
                    if i != q and len(x) == len(own):
                        s = sum(a * b for a, b in zip(own, x))
                        best[i] = max(best.get(i, s), s)
            ranked = sorted(best.items(), key=lambda e: (-e[1], e[0]))[:k]
            out += [(q, n + 1, i, s) for n, (i, s) in enumerate(ranked)]
    return sorted(out)


@pytest.mark.parametrize("block", [8192, 16])
def test_maxscore_is_exact(spark, monkeypatch, block):
    monkeypatch.setattr(maxscore, "BLOCK", block)
    rng = np.random.default_rng(block)
    data = [(i, [round(float(v), 1) for v in rng.normal(0, 0.4, 12)]) for i in range(300)]
    data += [(i, data[i - 300][1]) for i in range(300, 340)] + [(350, [0.0] * 12), (400, [1e6] * 12), (450, None), (451, [None] * 12), (452, [float("nan")] + [0.0] * 11), (453, [float("inf")] * 12), (None, [1.0] * 12), (500, [1.0, 2.0]), (550, [2.0, 1.0]), (600, [])]
    df = spark.createDataFrame([(i, x, 1, 1, 1) for i, x in data], "vec_id long, embedding array<double>, score int, shard int, rank int").repartition(5)
    use = maxscore.usable(df)
    got = [tuple(r) for r in maxscore.search(use, use.filter("vec_id % 50 = 0"), 5).collect()]
    assert sorted(got) == brute_top(data, [i for i, _ in data if i is not None and i % 50 == 0], 5)
    assert maxscore.search(use.limit(0), use, 5).count() == 0 and maxscore.search(use, use.limit(0), 5).count() == 0


def test_huge_components_stay_exact(spark):
    data = [(0, [2.0**40, 1.0]), (1, [2.0**40, 3.0]), (2, [2.0**40, 2.0]), (3, [1.0, 1.0])]
    use = maxscore.usable(spark.createDataFrame(data, "vec_id long, embedding array<double>"))
    got = [(r["vec_id"], r["rank"]) for r in maxscore.search(use, use.filter("vec_id = 3"), 2).collect()]
    assert got == [(1, 1), (2, 2)]


# --- decontamination -----------------------------------------------------------------------------------------


def brute_hits(text, items, size=10):
    pattern = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")
    low = lambda t: pattern.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    w, hit, ids = low(text), set(), set()
    for i, t in items:
        b = low(t)
        n = min(size, len(b))
        for k in range(len(b) - n + 1 if n else 0):
            for at in range(len(w) - n + 1):
                if w[at : at + n] == b[k : k + n]:
                    hit |= set(range(at, at + n))
                    if i is not None:
                        ids.add(str(i))
    return len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("chars", [4_000_000, 60])
def test_windows_are_found(spark, monkeypatch, chars):
    monkeypatch.setattr(decontamination, "TABLE_CHARS", chars)
    draw = random.Random(chars)
    say = lambda n: " ".join(draw.choice(("a", "B", "c", "Ñu", "d1")) for _ in range(n))
    items = [(i, say(draw.randint(8, 14))) for i in range(12)] + [(20, "Ñu c!"), (3, say(11)), (3, items_text := say(10)), (21, None), (22, ""), (23, "..."), (None, "zz yy"), (3, items_text)]
    texts = [(i, say(draw.randint(0, 120))) for i in range(40)] + [(50, "x " * 5 + items[4][1].upper().replace(" ", "--") + " y"), (51, None), (52, ""), (None, items[2][1]), (52, ""), (53, "zz, YY"), (54, (say(30) + "ſ K ") * 300)]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("item", F.lit("clash"))
    docs = documents(spark, texts).withColumn("hit", F.lit(1)).withColumn("items", F.lit(1)).withColumn("n_hit", F.lit(1))
    got = sorted((tuple(r) for r in decontamination.search(docs, bench).collect()), key=str)
    assert got == sorted(((i, *brute_hits(t, items)) for i, t in texts), key=str)
    assert decontamination.search(docs.limit(0), bench).count() == 0
    assert {r["n_hit"] for r in decontamination.search(docs, bench.limit(0)).collect()} == {0}


# --- secrets -------------------------------------------------------------------------------------------------


def test_fixed_patterns():
    text = 'é password="abc123" token:ab secret=token:longvalue AKIA' + "A" * 16 + " AKIAAAA " + "a1" * 12 + " " + "b" * 23 + " ſecret=abcdefgh api_Key = XYZ.123/="
    base, every = secret_scan.spans(text)
    found = [(k, text[a:b]) for k, a, b in base]
    assert found == [("assign", 'password="abc123'), ("access", "AKIA" + "A" * 16), ("hex", "a1" * 12), ("assign", "api_Key = XYZ.123/=")]
    assert set(base) <= set(every)


def test_assignments_are_lexed():
    text = "const K1 = 'Zx9qLm4tRv8w';\nclientSecret = K1\nname: somebody\ndb.pwd := \"aB3\" + 'x'\nsigning_key => 'Qw8Er5Ty2Ui9'\nkeyboard = 'plain letters'\n"
    base, every = secret_scan.spans(text)
    named = [text[a:b] for k, a, b in every if k == "named"]
    assert named == ["Zx9qLm4tRv8w", "Qw8Er5Ty2Ui9"]
    joined = "authToken_value = \"aB3x9\" + \"Kq7Zr2\""
    assert [joined[a:b] for k, a, b in secret_scan.spans(joined)[1]] == ['aB3x9" + "Kq7Zr2']


def test_literals_of_letters_only():
    text = "db.pwd = 'CorrectHorseBattery!'\npassphrase: \"horse\"\nsigning_key => 'plainletters'\nauth = 'QwErTyUiOpAs'\npwd = '<your pwd>'\ncredential = \"${CREDENTIAL}\"\npwd = '********'\nauth: Authentication\n"
    assert [text[a:b] for k, a, b in secret_scan.spans(text)[1]] == ["CorrectHorseBattery!", "horse", "plainletters", "QwErTyUiOpAs"]


def test_scan_and_redact(spark):
    texts = [(1, "password=hunter22 and more"), (1, "password=hunter22 and more"), (2, None), (3, ""), (None, "x"), (4, "word " * 50_000 + "token: abcdef0")]
    docs = documents(spark, texts).withColumn("spans", F.lit(1))
    got = {r["doc_id"]: r for r in secret_scan.scan(docs).collect()}
    assert secret_scan.scan(docs).count() == 6 and secret_scan.scan(docs.limit(0)).count() == 0
    assert (got[1]["n_assign"], got[1]["spans"]) == (1, "assign:0:17") and got[1]["base_sha256"] == hashlib.sha256(b"assign:0:17").hexdigest()
    assert got[2]["spans"] == "" and got[4]["spans"] == "assign:250000:250014"
    clean = {r["doc_id"]: r for r in secret_scan.redact(docs).collect()}
    assert clean[1]["text"] == "<secret> and more" and clean[1]["n_chars"] == 17 and clean[2]["text"] is None


# --- near duplicates -----------------------------------------------------------------------------------------


def brute_groups(texts, size, percent):
    low = lambda t: re.findall("[^\\x20\\x09-\\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    sets = []
    for _, t in texts:
        w = low(t)
        n = min(size, len(w))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set())
    root = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = root[a], root[b]
                if x != y:
                    root = [y if r == x else r for r in root]
    out = []
    for k, (i, _) in enumerate(texts):
        ids = [j for n, (j, _) in enumerate(texts) if root[n] == root[k] and j is not None]
        c = min(ids) if ids else None
        out.append((i, len(sets[k]), c, i == c))
    return out


def family(draw, words, n, edits):
    """Copies of one text with single words changed: some are alike only through the others."""
    base = [draw.choice(words) for _ in range(120)]
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(draw.randint(0, edits)):
            copy[draw.randrange(len(copy))] = f"w{draw.randrange(10**6)}"
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("size,percent,seed", [(3, 85, 1), (5, 80, 2), (3, 85, 3)])
def test_groups_equal_brute_force(spark, size, percent, seed):
    draw = random.Random(seed)
    words = [f"v{i}" for i in range(400)]
    texts = [t for edits in (2, 4, 6, 9) for t in family(draw, words, 45, edits)] + [" ".join(draw.choice(words) for _ in range(draw.randint(1, 60))) for _ in range(60)]
    texts += ["a b c d e f g", "A b c d e f g", "a b c d e f h", "a b", "A  b", "a", " ", "", None, None, "x y z " * 20_000, "x y z " * 20_001, texts[0], texts[0], texts[0] + " tail"]
    rows = list(enumerate(texts))
    draw.shuffle(rows)
    rows += [(None, texts[5]), (None, "alone with no id at all"), rows[3], rows[3]]
    docs = documents(spark, rows).withColumn("class", F.lit(1)).withColumn("key", F.lit(1)).withColumn("bucket", F.lit(1)).repartition(4)
    got = sorted((tuple(r) for r in near_duplicates.groups(docs, size, percent).collect()), key=str)
    assert got == sorted(brute_groups(rows, size, percent), key=str)
    kept = near_duplicates.representatives(docs, size, percent)
    assert kept.columns == docs.columns
    want = {(i, t) for (i, t), g in zip(rows, brute_groups(rows, size, percent)) if g[3]}
    left = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert set(left) == want and len([x for x in left if (x[1] or "").strip()]) == len({x for x in want if (x[1] or "").strip()})


def test_groups_of_nothing(spark):
    docs = documents(spark, [(1, None), (2, "")])
    assert sorted(tuple(r) for r in near_duplicates.groups(docs).collect()) == [(1, 0, 1, True), (2, 0, 2, True)]
    assert near_duplicates.groups(docs.limit(0)).count() == 0 and near_duplicates.representatives(docs.limit(0)).count() == 0


def test_word_hashes_do_not_depend_on_the_piece(monkeypatch):
    text = " ".join(f"w{i} Straße\t" for i in range(3000))
    whole = near_duplicates.word_hashes(text)
    monkeypatch.setattr(near_duplicates, "PIECE", 500)
    assert (near_duplicates.word_hashes(text) == whole).all() and len(whole) == len(text.split())
    assert (near_duplicates.word_hashes("ABC abc") == near_duplicates.word_hashes("abc ABC")).all()


def test_estimate_is_close():
    rng = np.random.default_rng(1)
    pool = np.unique(rng.integers(0, 1 << 63, 4000, dtype=np.uint64) * np.uint64(2))
    errors = []
    for n in (3400, 3700, 3900):
        a, b = np.sort(rng.permutation(pool)[:n]), np.sort(rng.permutation(pool)[:n])
        common = len(np.intersect1d(a, b))
        errors.append(near_duplicates.estimate(near_duplicates.sketch(a), near_duplicates.sketch(b), n, n) - common / (2 * n - common))
    assert max(map(abs, errors)) < 0.15


# --- mixing --------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("few", [50_000, 0])
def test_raked_weights_meet_the_targets(spark, monkeypatch, few):
    monkeypatch.setattr(mixing, "FEW", few)
    draw = random.Random(6)
    rows = [(i, "w " * draw.randint(1, 30) + draw.choice(("", " a | b ", "x@y", "{ ; }")), draw.choice(("en", "de", None)), draw.choice(("a", "a", "a", "b", "c")), 1) for i in range(2000)]
    rows += [(5000, None, "en", "a", 0), (5001, "", "xx", "zz", 0), (None, "one two", "en", "a", 7), rows[0]]
    docs = spark.createDataFrame(rows, DOCS).withColumn("topic", F.lit("clash")).withColumn("tokens", F.lit(1)).withColumn("weight", F.lit(1))
    mix = mixing.Mix(share=0.4)
    got = mixing.weigh(docs, mix).collect()
    assert len(got) == len(rows)
    cells = {}
    for (i, t, lang, source, _), topic in zip(rows, [topic_of(r[1]) for r in rows]):
        key = (source, lang or mixing.NONE, topic)
        cells[key] = cells.get(key, 0) + len((t or "").split())
    cells = {k: n for k, n in cells.items() if n}
    factor = {k: 1.0 for k in cells}
    total = sum(cells.values())
    wanted = []
    for d, name in enumerate(mixing.DIMENSIONS):
        sums = {}
        for k, n in cells.items():
            sums[k[d]] = sums.get(k[d], 0) + n
        p = {v: s ** mixing.FLATTEN[name] for v, s in sums.items()}
        wanted.append({v: x / sum(p.values()) for v, x in p.items()})
    for _ in range(200):
        for d in range(3):
            now = {}
            for k, n in cells.items():
                now[k[d]] = now.get(k[d], 0) + n * factor[k] / total
            for k in factor:
                factor[k] *= wanted[d][k[d]] / now[k[d]]
    by_id = {r["doc_id"]: r for r in got}
    for i, t, lang, source, _ in rows[:2000]:
        assert abs(by_id[i]["weight"] / factor[(source, lang or mixing.NONE, topic_of(t))] - 1) < 1e-2
    expected = sum(r["n_tokens"] * r["probability"] for r in got)
    assert abs(expected / sum(r["n_tokens"] for r in got) - 0.4) < 0.01
    u = {r[0]: r[1] for r in docs.select("doc_id", uniform(F.col("doc_id"), mix.seed)).collect()}
    assert all(r["drawn"] == (r["n_tokens"] > 0 and u[r["doc_id"]] < r["probability"]) for r in got)
    assert not by_id[5000]["drawn"] and not by_id[5001]["drawn"] and by_id[5001]["probability"] == 0
    assert mixing.weigh(docs.limit(0), mix).count() == 0


def topic_of(t):
    if not (t or "").strip():
        return "empty"
    return "code" if "{" in t and ";" in t else "table" if " | " in t else "web" if "@" in t or "http" in t else "prose"

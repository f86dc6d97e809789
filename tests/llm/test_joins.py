"""Hard negatives, the n-gram join and spelling variants against brute force."""

import math
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from shelfsync.llm import hard_negatives, ngram_join, spelling_variants
from shelfsync.llm.batches import stored

VECTORS = "vec_id long, embedding array<double>, label int, rank int, score int, shard int"


# --- hard negatives ------------------------------------------------------------------------------------------


@pytest.mark.parametrize("shape", [(1, 1, 1), (70, 64, 65), (129, 70, 200), (131, 261, 97), (0, 5, 3), (3, 0, 4)])
def test_strassen_is_exact(shape, monkeypatch):
    monkeypatch.setattr(hard_negatives, "LEAF", 8)
    rng = np.random.default_rng(sum(shape))
    a, b = rng.integers(-(1 << 40), 1 << 40, shape[:2]), rng.integers(-(1 << 15), 1 << 15, shape[1:])
    assert (hard_negatives.strassen(a, b) == a @ b).all()
    wrapped = hard_negatives.strassen(a << 20, b)
    assert (wrapped == (a << 20) @ b).all()


def test_strassen_saves_products(monkeypatch):
    monkeypatch.setattr(hard_negatives, "LEAF", 16)
    sizes = []

    class Counted(np.ndarray):
        def __matmul__(self, other):
            sizes.append(self.shape)
            return np.asarray(self) @ np.asarray(other)

    a, b = (np.arange(64 * 64).reshape(64, 64) % n for n in (17, 13))
    assert (hard_negatives.strassen(a.view(Counted), b.view(Counted)) == a @ b).all()
    assert len(sizes) == 49


def brute_mine(rows, anchors, n_positives, n_negatives, low, high):
    whole = {}
    for i, x, label in rows:
        if i is not None and label is not None and x is not None and all(v is not None and math.isfinite(v) and abs(v) * 256 < math.sqrt(2.0**62 / len(x)) for v in x):
            key = (label, [math.floor(256 * v) for v in x])
            whole[i] = min(whole.get(i, key), key)
    out = []
    for a in anchors:
        if a not in whole:
            continue
        label, own = whole[a]
        found = [(sum(p * q for p, q in zip(own, x)), i, other) for i, (other, x) in whole.items() if i != a and len(x) == len(own)]
        best = sorted(((s, i) for s, i, other in found if other == label), key=lambda e: (-e[0], e[1]))[:n_positives]
        for p, positive in best:
            near = [(s, i) for s, i, other in found if other != label and low * p <= 100 * s <= high * p]
            for rank, (s, i) in enumerate(sorted(near, key=lambda e: (-e[0], e[1]))[:n_negatives], 1):
                out.append((a, positive, rank, i, p, s))
    return sorted(out)


@pytest.mark.parametrize("tile", [(256, 4096), (3, 16)])
def test_hard_negatives_are_exact(spark, monkeypatch, tile):
    monkeypatch.setattr(hard_negatives, "ANCHORS", tile[0])
    monkeypatch.setattr(hard_negatives, "CANDIDATES", tile[1])
    rng = np.random.default_rng(tile[0])
    centres = rng.normal(0, 1, (3, 12))
    data = [(i, [round(float(v), 1) for v in centres[i % 3] + rng.normal(0, 0.3, 12)], int(i % 7 == 0) if i % 3 else 5) for i in range(300)]
    data += [(i, data[i - 300][1], i % 3) for i in range(300, 340)]
    data += [(350, [0.0] * 12, 1), (360, [1e6] * 12, 1), (370, None, 1), (371, [None] * 12, 1), (372, [float("nan")] + [0.0] * 11, 1), (373, [float("inf")] * 12, 1)]
    data += [(None, [1.0] * 12, 1), (380, [1.0] * 12, None), (390, [1.0, 2.0], 1), (391, [2.0, 1.0], 1), (392, [1.9, 1.0], 2), (400, [], 1), (401, [], 2), (402, [], 1)]
    data += [(10, data[10][1], 4), (20, data[20][1], data[20][2]), (410, [2.0**60] * 12, 1)]
    df = spark.createDataFrame([(*r, 1, 1, 1) for r in data], VECTORS).repartition(5)
    rows = hard_negatives.usable(df)
    found = hard_negatives.mine(rows, rows.filter("vec_id % 10 = 0"))
    ids = sorted({i for i, _, _ in data if i is not None and i % 10 == 0})
    wanted = brute_mine(data, ids, 5, 5, 80, 100)
    assert sorted(map(tuple, found.collect())) == wanted and len(wanted) > 100
    assert hard_negatives.mine(rows.limit(0), rows.limit(0)).count() == 0


def test_large_components_stay_exact(spark):
    data = [(0, [2.0**22, 1.0], 1), (1, [2.0**22, 3.0], 1), (2, [2.0**22, 2.0], 2), (3, [2.0**22, 4.0], 2), (4, [2.0**30, 1.0], 1)]
    rows = hard_negatives.usable(spark.createDataFrame(data, "vec_id long, embedding array<double>, label int"))
    found = hard_negatives.mine(rows, rows.filter("vec_id = 0"))
    assert [(r["positive_id"], r["negative_id"]) for r in found.collect()] == [(1, 2)]


@pytest.mark.parametrize("most", [1 << 8, 1 << 20, 1 << 28])
def test_products_are_exact_in_every_kind(most, monkeypatch):
    rng = np.random.default_rng(most)
    a, b = rng.integers(most - 9, most, (5, 64)), rng.integers(-most, -most + 9, (64, 7))
    wanted = [[sum(int(x) * int(y) for x, y in zip(row, col)) for col in b.T] for row in a]
    assert hard_negatives.strassen(a, b).tolist() == wanted
    monkeypatch.setattr(hard_negatives, "LEAF", 2)
    assert hard_negatives.strassen(a, b).tolist() == wanted


def test_hard_negatives_broadcast_nothing(spark):
    """The anchors' copies for all shards grow with the table, so they must not go through the driver."""
    rng = np.random.default_rng(5)
    data = [(i, [round(float(v), 1) for v in rng.normal(0, 1, 6)], i % 3) for i in range(200)]
    rows = hard_negatives.usable(spark.createDataFrame(data, "vec_id long, embedding array<double>, label int"))
    anchors = rows.filter("vec_id % 10 = 0")
    blocks = [stored(hard_negatives._blocks(df, size, key), "blocks") for df, size, key in ((rows, 64, "c"), (anchors, 8, "a"))]
    for found in (hard_negatives.positives(*blocks, 5), hard_negatives.mine(rows, anchors)):
        assert len(found.collect()) > 0
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


@pytest.mark.parametrize("held", [20_000, 3])
def test_heaps_are_kept_over_tiles(spark, monkeypatch, held):
    """Many equal scores, in blocks of few rows whose heaps are passed on between blocks of anchors."""
    monkeypatch.setattr(hard_negatives, "HELD", held)
    monkeypatch.setattr(hard_negatives, "SPREAD", 1)
    monkeypatch.setattr(hard_negatives, "SHARD_BYTES", held * 100)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 4)
    monkeypatch.setattr(hard_negatives, "CANDIDATES", 16)
    draw = random.Random(held)
    data = [(i, [draw.choice([0.0, 0.5, 1.0, -1.0]) * (1 if i % 50 else 300) for _ in range(4)], draw.randrange(3)) for i in draw.sample(range(400), 400)]
    rows = hard_negatives.usable(spark.createDataFrame(data, "vec_id long, embedding array<double>, label int").repartition(3))
    found = hard_negatives.mine(rows, rows.filter("vec_id % 10 = 0"), n_positives=4, n_negatives=3, low=60, high=95)
    wanted = brute_mine(data, range(0, 400, 10), 4, 3, 60, 95)
    assert sorted(map(tuple, found.collect())) == wanted and len(wanted) > 100


# --- n-gram join ---------------------------------------------------------------------------------------------

DOCS = "doc_id long, text string, class string, id long, n int, key string"


def brute_groups(texts, size, percent):
    sets = []
    for t in texts:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        w = [x for x in re.split("[\\x20\\x09-\\x0D]+", low) if x]
        k = min(size, len(w))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if k else set())
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    return sets, [find(i) for i in range(len(texts))]


def corpus(seed):
    """Families of near copies of many degrees, chains, copies, and texts that share a long passage."""
    draw = random.Random(seed)
    word = lambda: draw.choice("abcdefghij") + draw.choice("klmnop")
    passage = " ".join(word() for _ in range(60))
    texts = [None, "", " \t\n", "one", "One", "one two", "one two three four five", "ONE two\nthree\tfour  five"]
    for _ in range(8):
        base = [word() for _ in range(draw.choice([12, 40, 120]))]
        for _ in range(draw.randrange(1, 9)):
            new = list(base)
            for _ in range(draw.randrange(0, max(2, len(base) // 12))):
                new[draw.randrange(len(new))] = word()
            texts += [" ".join(new)] * draw.choice([1, 1, 1, 3])
    chain = [word() for _ in range(100)]
    for _ in range(10):
        chain = chain[4:] + [word() for _ in range(4)]
        texts.append(" ".join(chain))
    texts += [passage + " " + " ".join(word() for _ in range(n)) for n in (0, 3, 10, 15, 30, 200, 200, 200)]
    texts += ["x " * 5000, "x " * 3000 + "y"]
    draw.shuffle(texts)
    return texts


@pytest.mark.parametrize("seed,size,percent", [(1, 5, 80), (2, 3, 85), (3, 5, 80), (4, 2, 60)])
def test_the_join_loses_no_link(spark, monkeypatch, seed, size, percent):
    monkeypatch.setattr(ngram_join, "BROADCAST", 400_000 if seed % 2 else 0)
    monkeypatch.setattr(ngram_join, "BLOCK_BYTES", 1 << 20 if seed % 2 else 500)
    texts = corpus(seed)
    rows = [(10 * i, t, "clash", 1, 2, "clash") for i, t in enumerate(texts)]
    found = {r["doc_id"]: r for r in ngram_join.joined(spark.createDataFrame(rows, DOCS).repartition(6), size, percent).collect()}
    sets, roots = brute_groups(texts, size, percent)
    least = {}
    for i, r in enumerate(roots):
        least.setdefault(r, 10 * i)
    for i, s in enumerate(sets):
        row = found[10 * i]
        same = sum(x == s for x in sets) if s else 0
        assert (row["n_shingles"], row["component_id"], row["n_same"]) == (len(s), least[roots[i]], same)


def test_rows_of_all_kinds(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(None, text), (7, text + " more"), (7, text + " more"), (5, "alone here"), (None, None), (None, "by itself"), (9, "")]
    out = ngram_join.joined(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = Counter((r["doc_id"], r["n_shingles"], r["component_id"], r["n_same"]) for r in out)
    assert found == Counter({(None, 46, 7, 1): 1, (7, 47, 7, 2): 2, (5, 1, 5, 1): 1, (None, 0, None, 0): 1, (None, 1, None, 1): 1, (9, 0, 9, 0): 1})
    assert ngram_join.joined(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_the_product_counts_overlaps(spark):
    sets = {1: [1, 2, 3, 4, 5], 2: [1, 2, 3, 4, 6], 3: [1, 2, 3, 4, 5, 6], 4: [9]}
    frame = spark.createDataFrame([(i, len(s), np.array(s, np.uint64).tobytes()) for i, s in sets.items()], "id long, n long, set binary")
    pairs = spark.createDataFrame([(1, 2), (1, 3), (2, 3), (1, 4)], "a long, b long")
    assert sorted(map(tuple, ngram_join.product(pairs, stored(frame, "sets"), 80).collect())) == [(1, 3, 5), (2, 3, 5)]


def test_the_product_reads_sets_once(spark):
    frame = spark.createDataFrame([(i, 1, bytes(8)) for i in range(9)], "id long, n long, set binary")
    pairs = spark.createDataFrame([(0, i) for i in range(1, 9)], "a long, b long")
    out = ngram_join.product(pairs, stored(frame, "sets"), 80)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("set:binary") == 1 and out.count() == 8


def test_folded_columns_discard_no_similar_row(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "FOLDED", 3)
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(words), " ".join(words[:57]), " ".join(words[::-1]), "a b c d e f", "a b c d e f g"]
    out = ngram_join.joined(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in out} == {0: 0, 1: 0, 2: 2, 3: 3, 4: 4}


# --- spelling variants ---------------------------------------------------------------------------------------


def edits(word, letters):
    out = {word[:i] + word[i + 1 :] for i in range(len(word))}
    out |= {word[:i] + c + word[i + 1 :] for i in range(len(word)) for c in letters}
    out |= {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in letters}
    return out - {word}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_one_edit_changes_no_more_grams_than_the_bound(seed):
    draw = random.Random(seed)
    words = {"".join(draw.choice("abc") for _ in range(draw.randrange(5, 16))) for _ in range(300)}
    for group in (5, 6, 8, 11, 14):
        most = spelling_variants.longest_gram(group)
        counts = Counter()
        for w in words:
            if len(w) in (group, group + 1):
                s = spelling_variants.FIRST + w + spelling_variants.LAST
                counts.update(s[p : p + q] for q in range(2, most + 1) for p in range(len(s) - q + 1))
        frequent = {g: n for g, n in counts.items() if n > 3}
        for w in [w for w in words if len(w) in (group, group + 1)][:25]:
            grams, bound = spelling_variants.decomposed(w, most, frequent)
            assert len(grams) > bound or len(w) == group + 1
            for near in edits(w, "abx"):
                if len(near) in (group, group + 1):
                    others, limit = spelling_variants.decomposed(near, most, frequent)
                    shift = {(p + d, g) for p, g in others for d in (-1, 0, 1)}
                    common = sum(x in shift for x in grams)
                    assert common >= max(len(grams) - bound, len(others) - limit, 1), (w, near)


def brute_variants(texts, shortest, least, times, every):
    counts = Counter()
    for doc_id, text in texts:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", low):
            h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= shortest and n >= least}
    letters = {c for w in words for c in w}
    near = {w: edits(w, letters) & set(words) for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= times * n else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return out


@pytest.mark.parametrize("frequent,seed", [(64, 1), (2, 2)])
def test_variants_equal_brute_force(spark, monkeypatch, frequent, seed):
    monkeypatch.setattr(spelling_variants, "FREQUENT", frequent)
    draw = random.Random(seed)
    base = ["".join(draw.choice(["an", "er", "st", "é", "o", "ti", "Ö", "×"]) for _ in range(draw.randrange(2, 8))) for _ in range(120)]
    words = [w for b in base for w in [b] * draw.randrange(1, 40) + draw.sample(sorted(edits(b, "aeé")), 6) * draw.randrange(1, 5)]
    draw.shuffle(words)
    texts = [(draw.randrange(50), " ".join(w.upper() if draw.random() < 0.1 and w.isascii() else w for w in words[i : i + 30])) for i in range(0, len(words), 30)]
    texts += [(None, "Anker anker ANKER ankern"), (1, None), (2, ""), (3, "12 34 --"), (4, "a" * 50_000 + " " + "anker " * 2000), (4, "anker-anker_anker")]
    texts += texts[:5]
    df = spark.createDataFrame([(i, t, "clash", 1) for i, t in texts], "doc_id long, text string, word string, n int").repartition(4)
    found = {tuple(r) for r in spelling_variants.variants(df, 5, 3, 2, 7).collect()}
    assert found == brute_variants(texts, 5, 3, 2, 7) and len(found) > 50
    assert spelling_variants.variants(df.limit(0)).count() == 0

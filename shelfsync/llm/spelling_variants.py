"""Spelling variants by a variable-length gram index.

A dictionary of grams is pruned by frequency: a gram is extended only where it is frequent, so rare grams stay short and
common beginnings grow longer. A word falls into the longest dictionary grams that start at its places, without those
that lie inside another. One edit changes only grams around its place; the largest number that an edit at any place can
change is the word's bound. Two near words share all other grams, so the lists of each word's rarest `bound + 1` grams
are enough to merge. Pairs of a list are verified by edit distance within the join.

Near words differ in length by one at most. A gram group `g` holds the words of g and g + 1 code points and has a dictionary
of its own, whose longest gram is half a padded word at most; so every word keeps a gram whatever the edit, and short words
need no other way.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import pieces, stored

SHORTEST = 2  # code points of a gram at least
LONGEST = 8
#: Grams that occur more often than this are extended by a code point, or more often than a share of all.
FREQUENT = 64
#: The dictionary's frequent grams are broadcast; there are this many at most, as each has at least that share of all.
MOST_GRAMS = 400_000
#: Different words that a task counts before it passes them on.
HELD = 400_000
FIRST, LAST = "\x02", "\x03"
ROUNDS = 40
#: The fixed pattern of runs [A-Za-zÀ-ÿ]+ over UTF-8 with A-Z in lower case.
RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")


def runs(doc_id: int | None, text: str | None, every: int) -> Iterator[tuple[str, int]]:
    """The runs of a text with their counts; in one of `every` (by crc32 of id and run) a code point is missing."""
    start = crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in Counter(RUN.findall((text or "").encode("utf-8", "surrogatepass").lower())).items():
        h = crc32(run, start)
        word = run.decode()
        if every and h % every == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1 :]
        yield word, n


def counted(documents: DataFrame, shortest: int, least: int, every: int) -> DataFrame:
    """word and n of all words of `shortest` code points or more that occur `least` times or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["word", "n"])
            found.clear()
            return out

        for batch in batches:
            for part in pieces(batch):
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    for word, n in runs(doc_id, text, every):
                        if len(word) >= shortest:
                            found[word] += n
                if len(found) > HELD:
                    yield flush()
        yield flush()

    at = documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "word string, n long")
    return at.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def longest_gram(group: int) -> int:
    """Half of the shortest padded word of a group, so that an edit leaves a gram of every word unchanged."""
    return max(SHORTEST, min(LONGEST, (group + 2) // 2))


def _groups(word: str) -> tuple[int, int]:
    return len(word), len(word) - 1


def gram_counts(words: DataFrame) -> DataFrame:
    """group, gram and n: in how many places of the group's words every gram of any length occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[tuple[int, str]] = Counter()

        def flush() -> pa.RecordBatch:
            values = [[g for g, _ in found], [x for _, x in found], list(found.values())]
            out = pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, (pa.int32(), pa.string(), pa.int64()))], names=["group", "gram", "n"])
            found.clear()
            return out

        for batch in batches:
            for word in batch.column(0).to_pylist():
                s = FIRST + word + LAST
                for g in _groups(word):
                    for q in range(SHORTEST, longest_gram(g) + 1):
                        found.update([(g, s[p : p + q]) for p in range(len(s) - q + 1)])
                if len(found) > HELD:
                    yield flush()
        yield flush()

    at = words.select("word").mapInArrow(run, "group int, gram string, n long")
    return at.groupBy("group", "gram").agg(F.sum("n").alias("n"))


def frequent_grams(words: DataFrame) -> dict[int, dict[str, int]]:
    """The grams that are extended, by group, with their counts: the inner nodes of the pruned dictionary."""
    counts = stored(gram_counts(words), "grams")
    total = counts.agg(F.sum("n")).first()[0] or 0
    often = max(FREQUENT, -(-total // MOST_GRAMS))
    out: dict[int, dict[str, int]] = {}
    for group, gram, n in counts.filter(F.col("n") > often).toLocalIterator():
        out.setdefault(group, {})[gram] = n
    return out


def decomposed(word: str, longest: int, frequent: dict[str, int]) -> tuple[list[tuple[int, str]], int]:
    """The variable grams (place, gram) of a word, and how many of them one edit can change at most."""
    s = FIRST + word + LAST
    n = len(s)
    reach = []  # how many code points from each place on are a frequent gram
    for p in range(n):
        q = SHORTEST - 1
        while q + 1 < longest and p + q + 1 <= n and s[p : p + q + 1] in frequent:
            q += 1
        reach.append(q)
    grams, ends, last = [], [], 0
    for p in range(n - SHORTEST + 1):
        end = min(n, p + reach[p] + 1)
        if end > last:
            grams.append((p, s[p:end]))
            ends.append(end)
            last = end
    starts = [p for p, _ in grams]
    most = 0
    low = 0
    for i in range(1, n):  # an edit at i, or before it
        while i - low > min(reach[low], longest - 1):
            low += 1  # grams that start before `low` end before i whatever stands there
        high = min(i + 1 + reach[i + 1], i + longest - 1) if i + 1 < n else n
        hit = sum(1 for p, e in zip(starts, ends) if low <= p <= i or (p > i and e - 1 <= high))
        most = max(most, hit)
    return grams, most


def letters(word: str) -> int:
    """Which letters (by 64 remainders of their code points) a word has an odd number of; one edit alters two bits at most."""
    mask = 0
    for c in word:
        mask ^= 1 << (ord(c) & 63)
    return mask - (mask >> 63 << 64)


def postings(words: DataFrame, frequent: dict[int, dict[str, int]]) -> DataFrame:
    """Rows of the gram lists: gram, at (group and place), side (0: the group's shorter words as left side, 1: right side), word, n, mask.

    Grams of near words stand at the same place, or after the edit one further in the longer word.
    """
    known = words.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["gram", "at", "side", "word", "n", "mask"]
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
        for batch in batches:
            for start in range(0, batch.num_rows, 5000):
                part = batch.slice(start, 5000)
                rows = []
                for word, n in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    mask = letters(word)
                    for g in _groups(word):
                        frequent = known.value.get(g, {})
                        grams, most = decomposed(word, longest_gram(g), frequent)
                        grams.sort(key=lambda x: (frequent.get(x[1], 0), x[1]))
                        for p, gram in grams[: most + 1]:
                            at = (g << 32) + p
                            if g == len(word):
                                rows += [(gram, at, 0, word, n, mask), (gram, at, 1, word, n, mask)]
                            else:
                                rows += [(gram, at, 1, word, n, mask), (gram, at - 1, 1, word, n, mask)]
                cols = list(zip(*rows)) if rows else [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

    return words.select("word", "n").mapInArrow(run, "gram string, at long, side int, word string, n long, mask long")


def near_pairs(words: DataFrame) -> DataFrame:
    """a, n_a, b, n_b: every two words at an edit distance of exactly one, once (a the shorter, or the smaller)."""
    lists = stored(postings(words, frequent_grams(words)), "postings")
    left = lists.filter("side = 0").select("gram", "at", F.col("word").alias("a"), F.col("n").alias("n_a"), F.col("mask").alias("mask_a"))
    right = lists.filter("side = 1").select("gram", "at", F.col("word").alias("b"), F.col("n").alias("n_b"), F.col("mask").alias("mask_b"))
    # the first test is cheap and leaves few pairs to the others
    near = "bit_count(mask_a ^ mask_b) <= 2 AND (length(b) > length(a) OR a < b) AND levenshtein(a, b, 1) = 1"
    return left.join(right, ["gram", "at"]).filter(near).select("a", "n_a", "b", "n_b").distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """word and root of every word that has a form, by doubling; counts at least double along a chain, so it ends."""
    at = stored(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(ROUNDS):
        further = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        met = stored(at.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        at = met.select("word", "root")
        if met.filter("moved").isEmpty():
            return at
    raise RuntimeError("chains of forms did not end")


def variants(documents: DataFrame, shortest: int = 5, least: int = 3, times: int = 2, every: int = 0) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of all texts.

    Words are runs of Latin letters, A-Z in lower case, of `shortest` code points (3 or more) that occur `least` times.
    A word's form is its near word with the largest n (ties: the smallest), if that is `times` its own n or more, and
    root is the end of the chain of forms. `every` > 0 plants errors: of one run in `every`, by crc32, a code point is left out.
    Null and empty texts have no words; a null id counts as an empty one; repeated rows count as often as they occur; an
    empty table gives no rows; columns other than doc_id and text are not read.
    """
    words = stored(counted(documents, shortest, least, every), "words")
    pairs = stored(near_pairs(words), "near")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("n_b").alias("other_n"))
    both = both.union(pairs.select(F.col("b").alias("word"), F.col("a").alias("other"), F.col("n_a").alias("other_n")))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("m"), F.col("other").alias("form"))).alias("best"))
    best = best.select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.m")).alias("form_n"))
    found = words.join(best, "word", "left")
    takes = F.col("form_n") >= times * F.col("n")
    found = found.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), *(F.when(takes, F.col(c)).alias(c) for c in ("form", "form_n")))
    found = stored(found, "forms")
    out = found.join(_roots(found.filter("form IS NOT NULL")), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

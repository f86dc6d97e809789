"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The alphabet is the words of a text. The shift table maps every block of two words that some test string
holds to the distance of its last place from the end of the strings; at a block it lacks, the search jumps
over a whole string. A shift of zero leads to the bucket of strings with that suffix, which are compared
word by word. Test strings of other lengths than the usual window have tables of their own.
"""

from __future__ import annotations

import hashlib
import re
from itertools import pairwise

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import map_columns, stored

#: The fixed word pattern, over text with A-Z in lower case.
WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}
#: Characters of test strings that one search table holds; further items make further tables.
TABLE_CHARS = 4_000_000


def words(text: str | None) -> list[str]:
    return WORD.findall(text.translate(LOWER)) if text else []


class WuManber:
    """Search for test strings of one length, at least one word."""

    def __init__(self, strings: dict[tuple[str, ...], list[int]]):
        self.length = len(next(iter(strings)))
        self.block = min(2, self.length)
        self.longest = self.length - self.block + 1
        self.shift: dict = {}
        self.buckets: dict[object, list[tuple[tuple[str, ...], list[int]]]] = {}
        for string, items in strings.items():
            for end in range(self.block, self.length + 1):
                block = self._block(string, end)
                self.shift[block] = min(self.shift.get(block, self.longest), self.length - end)
            self.buckets.setdefault(self._block(string, self.length), []).append((string, items))

    def _block(self, string, end: int):
        return (string[end - 2], string[end - 1]) if self.block == 2 else string[end - 1]

    def find(self, text: list[str], blocks: list, hit, items: set[int]) -> None:
        """Marks the words of every occurrence and adds the items of the strings found.

        `blocks` holds the block that ends at each word: pairs of words from the second one on, or words.
        """
        at, shift, longest, length, skip = self.length - 1, self.shift, self.longest, self.length, self.block - 1
        end = len(text)
        while at < end:
            jump = shift.get(blocks[at - skip], longest)
            if jump:
                at += jump
                continue
            start = at - length + 1
            found = tuple(text[start : at + 1])
            for string, of in self.buckets[blocks[at - skip]]:
                if string == found:
                    hit[start : at + 1] = b"\1" * length
                    items.update(of)
            at += 1


def tables(items: list[tuple[int, str]], window: int) -> list[WuManber]:
    """One search table for each length of test string. `items`: place in the list of ids, and text."""
    strings: dict[int, dict[tuple[str, ...], list[int]]] = {}
    for item, text in items:
        w = words(text)
        size = min(window, len(w))
        for i in range(len(w) - size + 1 if size else 0):
            of = strings.setdefault(size, {}).setdefault(tuple(w[i : i + size]), [])
            if not of or of[-1] != item:
                of.append(item)
    return [WuManber(s) for s in strings.values()]


def _blocks_of_items(benchmark: DataFrame) -> list[DataFrame]:
    """The benchmark in parts whose texts have at most about TABLE_CHARS characters, by a hash of the row."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text")).filter("text IS NOT NULL").distinct()
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = 1 + total // TABLE_CHARS
    if parts == 1:
        return [items]
    items = stored(items.withColumn("part", F.pmod(F.xxhash64("item", "text"), F.lit(parts))), "items")
    return [items.filter(F.col("part") == k).drop("part") for k in range(parts)]


def search(documents: DataFrame, benchmark: DataFrame, window: int = 10, carry: tuple[str, ...] = (), with_text: bool = False) -> DataFrame:
    """Which words of each document lie in a window of a benchmark item.

    Returns one row per document row: doc_id, the text if asked for, the columns of `carry`, n_words, n_hit, n_items, items_sha256 (of
    the ids as sorted strings), contaminated. A null or empty document has no words. Items with null
    text are left out; one with a null id marks words, but is not counted or listed. Repeated items count once. The benchmark is searched in
    parts of bounded size, each sent to the tasks on its own; words hit are carried from part to part, so no
    shuffle is needed.
    """
    spark = documents.sparkSession
    carry = tuple(n for n in carry if n not in ("doc_id", "text"))
    at = documents.select("doc_id", "text", *carry)
    own = ", ".join(f"`{n}` {t}" for n, t in at.dtypes if n != "text" or with_text)
    more = ", hit binary, items array<string>" if with_text else ", text string, hit binary, items array<string>"
    at = at.withColumn("hit", F.lit(None).cast("binary")).withColumn("items", F.array().cast("array<string>"))
    parts = _blocks_of_items(benchmark)
    for k, part in enumerate(parts):
        rows = [(r["item"], r["text"]) for r in part.toLocalIterator()]  # at most about TABLE_CHARS
        sent = spark.sparkContext.broadcast((rows, window, k + 1 == len(parts)))
        kind = own + (RESULT if k + 1 == len(parts) else more)
        at = map_columns(at, kind, lambda sent=sent: _searcher(*sent.value))
        if k + 1 < len(parts):
            at = stored(at, "searched")
    return at


RESULT = ", n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def _searcher(items: list[tuple[str | None, str]], window: int, last: bool):
    names = [i for i, _ in items]
    made = tables([(k, t) for k, (_, t) in enumerate(items)], window)

    def rows(at):
        hits, found = [], []
        for text, hit, ids in zip(at["text"], at["hit"], at["items"]):
            w = words(text)
            marks = bytearray(hit) if hit else bytearray(len(w))
            new: set[int] = set()
            pairs = list(pairwise(w))
            for search in made:
                search.find(w, pairs if search.block == 2 else w, marks, new)
            hits.append(bytes(marks))
            found.append(sorted({*ids, *(names[k] for k in new if names[k] is not None)}))
        at = {**at, "hit": hits, "items": found}
        return {**at, **_summary(hits, found)} if last else at

    return rows


def _summary(hits: list[bytes], items: list[list[str]]) -> dict[str, list]:
    n_hit = [h.count(1) for h in hits]
    return {
        "n_words": [len(h) for h in hits],
        "n_hit": n_hit,
        "n_items": [len(i) for i in items],
        "items_sha256": [hashlib.sha256(",".join(i).encode()).hexdigest() for i in items],
        "contaminated": [n > 0 for n in n_hit],
    }

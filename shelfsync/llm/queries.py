"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.base import Query, ready
from . import decontamination, hard_negatives, html_text, language_id, masked_lm, maxscore, mixing, near_duplicates, ngram_join, secret_scan, spelling_variants, toxicity, warc_archive
from .batches import remainder, table

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, root: str) -> DataFrame:
        ready(spark)
        return fn(spark, root)

    QUERIES[fn.__name__] = run
    return fn


def _held(df: DataFrame, fold: int, held: int, *names: str) -> DataFrame:
    return df.select("doc_id", (remainder(F.col("doc_id"), fold) == held).alias("held_out"), *names)


@query
def op1_html_text(spark: SparkSession, root: str) -> DataFrame:
    return html_text.extract(table(spark, root, "pages"))


@query
def op2_warc(spark: SparkSession, root: str) -> DataFrame:
    return warc_archive.round_trip(table(spark, root, "pages"))


@query
def op3_toxicity(spark: SparkSession, root: str) -> DataFrame:
    documents = table(spark, root, "documents")
    model = toxicity.learn(documents, table(spark, root, "labels"), fold=4, held=2)
    return _held(toxicity.score(documents, model, threshold=0.3), 4, 2, "score", "predicted")


@query
def op4_masked_lm(spark: SparkSession, root: str) -> DataFrame:
    documents = table(spark, root, "documents")
    chunks = masked_lm.lexed(documents)
    counts = masked_lm.counted(documents, chunks)
    known = masked_lm.vocabulary(documents, counts)
    codes = masked_lm.coded(documents, known, counts, chunks)
    return masked_lm.score(documents, known, masked_lm.learn(documents, known, codes), counts, codes)


@query
def op5_maxscore(spark: SparkSession, root: str) -> DataFrame:
    vectors = maxscore.usable(table(spark, root, "embeddings"), scale=256.0)
    return maxscore.search(vectors, vectors.filter("vec_id % 50 = 0"), k=5)


@query
def op6_mixing(spark: SparkSession, root: str) -> DataFrame:
    return mixing.weigh(table(spark, root, "documents"), mixing.Mix(share=0.5))


@query
def op7_language(spark: SparkSession, root: str) -> DataFrame:
    documents = table(spark, root, "documents")
    found = language_id.predict(documents, language_id.learn(documents, fold=3, held=1))
    return _held(found, 3, 1, "lang_pred", "score", "accepted")


@query
def op8_decontamination(spark: SparkSession, root: str) -> DataFrame:
    return decontamination.search(table(spark, root, "documents"), table(spark, root, "benchmark"), window=10)


@query
def op9_secrets(spark: SparkSession, root: str) -> DataFrame:
    return secret_scan.scan(table(spark, root, "documents"))


@query
def op10_near_duplicates(spark: SparkSession, root: str) -> DataFrame:
    return near_duplicates.groups(table(spark, root, "documents"), size=3, percent=85)


@query
def op11_hard_negatives(spark: SparkSession, root: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = hard_negatives.usable(table(spark, root, "embeddings").withColumn("label", moved), scale=256.0)
    return hard_negatives.mine(rows, rows.filter("vec_id % 100 = 0"), n_positives=5, n_negatives=5, low=80, high=100)


@query
def op12_ngram_join(spark: SparkSession, root: str) -> DataFrame:
    return ngram_join.joined(table(spark, root, "documents"), size=5, percent=80)


@query
def op13_spelling_variants(spark: SparkSession, root: str) -> DataFrame:
    return spelling_variants.variants(table(spark, root, "documents"), shortest=5, least=3, times=2, every=97)


# --- SQL -----------------------------------------------------------------------------------------------------

UPPER, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLES["op5_maxscore"] = """
WITH v AS (
  SELECT vec_id, [CAST(floor(256.0 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS t FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum([p[1] * p[2] FOR p IN list_zip(q.t, c.t)])::BIGINT AS score
  FROM v q, v c WHERE q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s
)
SELECT query_id, n::INTEGER AS rank, vec_id, score FROM r WHERE n <= 5
"""

ORACLES["op8_decontamination"] = rf"""
WITH d AS (
  SELECT doc_id, rowid AS r, w FROM (
    SELECT doc_id, row_number() OVER () AS rowid,
      regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{SMALL}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents)
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
    regexp_extract_all(translate(text, '{UPPER}', '{SMALL}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL
), g AS (
  SELECT DISTINCT item, least(len(w), 10) AS size, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS gram
  FROM (SELECT item, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT size FROM g),
p AS (
  SELECT r, size, i, array_to_string(w[i : i + size - 1], ' ') AS gram
  FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size)
), hits AS (SELECT p.r, p.i, p.size, g.item FROM p JOIN g USING (size, gram)),
marked AS (SELECT r, count(DISTINCT k) AS n FROM (SELECT r, unnest(range(i, i + size)) AS k FROM hits) GROUP BY r),
named AS (SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item COLLATE "C") AS ids
  FROM (SELECT DISTINCT r, item FROM hits WHERE item IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(marked.n, 0)::BIGINT AS n_hit, coalesce(named.n, 0)::BIGINT AS n_items,
  sha256(coalesce(named.ids, '')) AS items_sha256, coalesce(marked.n, 0) > 0 AS contaminated
FROM d LEFT JOIN marked USING (r) LEFT JOIN named USING (r)
"""

ORACLES["op10_near_duplicates"] = rf"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{SMALL}'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), g AS (
  SELECT r, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE [array_to_string(w[i : i + 2], ' ') FOR i IN range(1, len(w) - 1)] END)) AS s
  FROM d
), n AS (SELECT r, count(*) AS n FROM g GROUP BY r),
p AS (SELECT a.r AS a, b.r AS b, count(*) AS c FROM g a JOIN g b ON a.s = b.s AND a.r < b.r GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
s AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach AS (SELECT r AS a, r AS b FROM d UNION SELECT reach.a, s.b FROM reach JOIN s ON reach.b = s.a),
m AS (SELECT a AS r, min(doc_id) AS component_id FROM reach JOIN d ON d.r = reach.b GROUP BY a)
SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept
FROM d JOIN m USING (r) LEFT JOIN n USING (r)
"""

ORACLES["op11_hard_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [CAST(floor(256.0 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS t
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT a.vec_id AS a, c.vec_id AS c, a.label = c.label AS same, list_sum([p[1] * p[2] FOR p IN list_zip(a.t, c.t)])::BIGINT AS score
  FROM v a, v c WHERE a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id
), p AS (
  SELECT a, c AS p, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, c) <= 5
)
SELECT p.a AS anchor_id, p.p AS positive_id, row_number() OVER (PARTITION BY p.a, p.p ORDER BY s.score DESC, s.c)::INTEGER AS rank,
  s.c AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.a = p.a AND NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score
QUALIFY rank <= 5
"""

ORACLES["op12_ngram_join"] = rf"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{SMALL}'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT r, doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE [array_to_string(w[i : i + 4], ' ') FOR i IN range(1, len(w) - 3)] END)) AS s
  FROM d
), g AS (SELECT r, unnest(s) AS s FROM sets),
n AS (SELECT r, count(*) AS n FROM g GROUP BY r),
p AS (SELECT a.r AS a, b.r AS b, count(*) AS c FROM g a JOIN g b ON a.s = b.s AND a.r < b.r GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
s AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach AS (SELECT r AS a, r AS b FROM d UNION SELECT reach.a, s.b FROM reach JOIN s ON reach.b = s.a),
m AS (SELECT a AS r, min(doc_id) AS component_id FROM reach JOIN d ON d.r = reach.b GROUP BY a),
same AS (SELECT s, count(*) AS n_same FROM sets WHERE len(s) > 0 GROUP BY s)
SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, coalesce(n_same, 0)::BIGINT AS n_same
FROM sets JOIN m USING (r) LEFT JOIN n USING (r) LEFT JOIN same USING (s)
"""

# crc32 by its table of 256 entries; near words by what is left of them without one code point
ORACLES["op13_spelling_variants"] = rf"""
WITH RECURSIVE e AS (
  SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
  FROM (SELECT unnest(range(256)) AS i)
), crc AS (SELECT list(c ORDER BY i) AS t FROM e),
r AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{SMALL}'), '[a-zÀ-ÿ]+')) AS run FROM documents)
  GROUP BY ALL
), u AS (
  SELECT run, n, flatten([CASE WHEN unicode(c) < 128 THEN [unicode(c)] ELSE [192 + (unicode(c) >> 6), 128 + (unicode(c) & 63)] END
    FOR c IN string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, '')]) AS bytes
  FROM r
), h AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295, [b::BIGINT FOR b IN bytes]), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM u, crc
), w AS (
  SELECT CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, sum(n)::BIGINT AS n
  FROM h GROUP BY 1 HAVING length(word) >= 5 AND sum(n) >= 3
), d AS (
  SELECT word, i, left(word, i) || substr(word, i + 2) AS rest FROM (SELECT word, unnest(range(length(word))) AS i FROM w)
), p AS (
  SELECT a.word, b.word AS other FROM d a JOIN d b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT d.word, w.word FROM d JOIN w ON d.rest = w.word
  UNION SELECT w.word, d.word FROM d JOIN w ON d.rest = w.word
), best AS (
  SELECT p.word, count(*) AS n_near, first(w.word ORDER BY w.n DESC, w.word COLLATE "C") AS form, max(w.n) AS form_n
  FROM p JOIN w ON w.word = p.other GROUP BY p.word
), f AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 2 * n THEN form END AS form, CASE WHEN form_n >= 2 * n THEN form_n END AS form_n
  FROM w LEFT JOIN best USING (word)
), up AS (
  SELECT word, word AS root, form AS next FROM f
  UNION ALL SELECT up.word, up.next, f.form FROM up JOIN f ON f.word = up.next
)
SELECT f.word, f.form, up.root, f.n, f.n_near, f.form_n FROM f JOIN up ON up.word = f.word AND up.next IS NULL
"""

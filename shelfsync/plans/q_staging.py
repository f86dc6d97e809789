"""Queries for the staging run: its jobs over two states of the source, one after the other."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import sync
from ..operators.schema import create_table
from ..operators.tree import category_paths
from ..sources.snapshots import SnapshotStore
from . import catalog as cat
from .base import query, scratch, sql_slug, table
from .staging import STAGING_TABLES, article_run_order, stage_entities

NOW = ("2024-06-01T00:00:00+00:00", "2024-06-02T00:00:00+00:00")


def _categories(spark, d, run: int):
    """Regions as top categories and nations below them; some names change with the second state."""
    region, nation = table(spark, d, "region"), table(spark, d, "nation")
    text = lambda c: c.cast("string")
    top = region.select(text(F.col("r_regionkey") + 1).alias("Warengruppe"), F.lit("0").alias("Anhang"), F.col("r_name").alias("Bezeichnung"))
    newer = F.when((F.col("n_regionkey") == 1) & F.lit(run == 2), F.concat("n_name", F.lit(" neu"))).otherwise(F.col("n_name"))
    below = nation.select(text(F.col("n_nationkey") + 100).alias("Warengruppe"), text(F.col("n_regionkey") + 1).alias("Anhang"), newer.alias("Bezeichnung"))
    none = {n: F.lit(None).cast("string") for n in ("Ebene", "Beschreibung", "Bild", "Bild_gross", "Update")}
    return top.unionByName(below).withColumns({**none, "Internet": F.lit("1"), "ordinal": F.col("Warengruppe").cast("bigint")})


def _articles(spark, d, run: int):
    """The parts. In the first state large ones go by another number, so that they vanish and others come with the second."""
    c, key = F.col, F.col("p_partkey")
    number = F.concat(F.when((c("p_size") > 45) & F.lit(run == 1), "Q").otherwise("P"), key.cast("string"))
    name = F.when((c("p_type") == "LARGE") & F.lit(run == 2), F.upper("p_name")).otherwise(c("p_name"))
    price = c("p_retailprice") + F.when((c("p_brand") == "Brand#7") & F.lit(run == 2), 1.0).otherwise(0.0)
    kind = c("p_type")
    value = F.concat(F.when((c("p_brand") == "Brand#7") & F.lit(run == 2), "w").otherwise("v"), c("p_size").cast("string"))
    rows = table(spark, d, "part").select(
        key.cast("string").alias("Artikel"), number.alias("Artikelnummer"), F.concat(F.lit(" "), name).alias("Bezeichnung"),
        F.replace(F.round(price, 2).cast("string"), F.lit("."), F.lit(",")).alias("VK3"),
        (c("p_size") % 30 + 100).cast("string").alias("Warengruppe"),
        F.when(kind == "PROMO", "7").when(kind == "SMALL", "0").when(kind == "LARGE", "16,0").otherwise("19.00").alias("Umsatzsteuer"),
        F.when(c("p_brand") == "Brand#1", "Master").when(c("p_brand") == "Brand#2", F.concat(F.lit("P"), "p_size")).otherwise("").alias("Zusatzfeld07"),
        F.when(kind == "SMALL", "nein").otherwise("ja").alias("Internet"), F.concat(F.lit("C:\\b\\"), key.cast("string"), F.lit(".jpg")).alias("Bild1"),
        F.when(key % 3 == 0, "Color").when(key % 3 == 1, " Form").otherwise(" ").alias("Zusatzfeld03"), value.alias("Zusatzfeld15"),
        F.lit("Size").alias("Zusatzfeld04"), c("p_size").cast("string").alias("Zusatzfeld16"),
        F.when(key % 5 == 0, "Color").alias("Zusatzfeld05"), F.lit("x").alias("Zusatzfeld17"), (c("p_size") % 2 == 0).alias("has_text"),
    )
    rest = "EANNummer Langtext Werbetext1 Bemerkung Einheit Bruttogewicht Bestand Update Zusatzfeld06 Zusatzfeld18".split()
    return rows.withColumns({n: F.lit(None).cast("string") for n in rest})


def _vault(spark, d, run: int, kind: str):
    """The media files of one kind. With the second state files of low quality have another content."""
    doc, lang = F.col("media_id").cast("string"), F.col("lang")
    again = F.coalesce(F.col("quality") == 0, F.lit(False)) & F.lit(run == 2)
    return cat.media(spark, d).where(F.col("kind") == kind).select(
        F.substring_index(F.replace("path", F.lit("\\"), F.lit("/")), "/", -1).alias("file_name"),
        F.concat(F.when(again, "new-").otherwise("c-"), doc).alias("checksum"), F.col("path").alias("source_path"),
        F.when(lang == "de", "1").when(lang == "fr", "2").alias("art_type"), F.when(lang == "de", doc).alias("art_id"),
        F.when(lang == "fr", F.col("source")).alias("cat_id"), F.lit("image/jpeg" if kind == "image" else "application/pdf").alias("mime"),
        "size", doc.alias("stored_file"), F.lit("v").alias("stored_path"), F.lit("t").alias("stored_at"),
    )


def _documents(spark, d, run: int):
    moved = F.coalesce(F.col("toxic") == 1, F.lit(False)) & F.lit(run == 2)
    doc = F.col("media_id")
    return cat.media(spark, d).select(
        doc.alias("Zaehler"), F.concat(F.when(moved, "R").otherwise("P"), (doc % 100).cast("string")).alias("Artikel"),
        F.concat(F.lit("x\\"), "source", F.lit("-"), doc.cast("string"), F.lit(".pdf")).alias("Titel"),
    )


def _staged(spark, d, names: list[str]) -> SnapshotStore:
    """The named jobs over the first state of the source, then over the second; an entity that fails ends it."""
    store = SnapshotStore(spark, scratch(spark, "staging"))
    for name, declared in STAGING_TABLES.items():
        store.write(name, create_table(spark, declared))
    for run in (1, 2):
        tree = _categories(spark, d, run)
        paths = category_paths(tree, "Warengruppe", "Anhang", "Bezeichnung").checkpoint()
        articles = article_run_order(_articles(spark, d, run)).checkpoint()
        number = F.when(F.col("has_text"), F.col("Artikelnummer")).otherwise(" ")
        texts = _articles(spark, d, run).select(number.alias("Artikelnummer"), F.concat(F.lit(" T"), "Artikel").alias("Meta_Title"), F.lit("").alias("Meta_Description"))
        sources = {
            "category": lambda tree=tree: tree, "article": lambda articles=articles: articles, "article_texts": lambda texts=texts: texts,
            "image_vault": lambda run=run: _vault(spark, d, run, "image"), "document_vault": lambda run=run: _vault(spark, d, run, "document"),
            "document": lambda run=run: _documents(spark, d, run),
        }
        stats = sync.run_entities(spark, stage_entities(NOW[run - 1]), sources, store, names, {"category_paths": paths})
        failed = stats.where("error is not null").first()
        if failed:
            raise RuntimeError(f"{failed['entity']}: {failed['error']}")
    return store


_STAGED_SQL = f"""
c AS (SELECT r_regionkey + 1 AS code, 'de/' || {sql_slug("r_name")} AS slug FROM region
      UNION ALL SELECT n_nationkey + 100, 'de/' || {sql_slug("r_name")} || '/' || {sql_slug("n_name")} FROM nation JOIN region ON n_regionkey = r_regionkey),
g AS (SELECT code, slug, row_number() OVER (ORDER BY code) AS id FROM c),
a AS (SELECT p_partkey AS k, p_name, p_size, p_type, p_brand, p_retailprice AS price, p_size % 30 + 100 AS code, CASE WHEN p_brand = 'Brand#2' THEN 1 ELSE 0 END AS rank,
             CASE WHEN p_brand = 'Brand#2' THEN 'P' || p_size END AS master, {sql_slug("p_name", words=False, accents=False)} AS words FROM part),
one AS (SELECT *, row_number() OVER (ORDER BY rank, model) AS id FROM (SELECT *, CASE WHEN p_size > 45 THEN 'Q' ELSE 'P' END || k AS model FROM a)),
two AS (SELECT *, row_number() OVER (ORDER BY rank, model) AS ord FROM (SELECT *, 'P' || k AS model FROM a)),
b AS (SELECT one.*, coalesce(g.id, 0) AS category, coalesce(g.slug, 'de') || '/' || words AS base FROM one LEFT JOIN g ON one.code = g.code),
s AS (SELECT *, row_number() OVER (PARTITION BY base ORDER BY id) - 1 AS slot FROM b),
n AS (SELECT two.*, coalesce(own.id, 0) AS category, coalesce(g.slug, 'de') || '/' || two.words AS base,
             (SELECT count(*) FROM one) + row_number() OVER (ORDER BY ord) AS id
      FROM two LEFT JOIN g own ON two.code = own.code LEFT JOIN b m ON m.model = two.master LEFT JOIN g ON g.id = coalesce(m.category, own.id) WHERE two.p_size > 45),
u AS (SELECT *, coalesce((SELECT count(*) FROM b WHERE b.base = n.base), 0) + row_number() OVER (PARTITION BY base ORDER BY ord) - 1 AS slot FROM n),
w AS (SELECT model, id, k, p_name, p_size, p_type, p_brand, price, category, master, base, slot, 'old' AS state FROM s
      UNION ALL SELECT model, id, k, p_name, p_size, p_type, p_brand, price, category, master, base, slot, 'new' FROM u)"""


@query("stage_articles", f"""
WITH {_STAGED_SQL},
x AS (SELECT *, model LIKE 'Q%' AS gone, NOT gone AND p_type = 'LARGE' AS renamed, NOT gone AND p_brand = 'Brand#7' AS dearer FROM w)
SELECT id, model, CASE WHEN renamed THEN upper(p_name) ELSE p_name END AS name, round(price + CASE WHEN dearer THEN 1.0 ELSE 0.0 END, 2) AS price,
       CAST(CASE p_type WHEN 'PROMO' THEN 2 WHEN 'SMALL' THEN 0 WHEN 'LARGE' THEN 16 ELSE 1 END AS BIGINT) AS tax_class_id,
       CAST(CASE WHEN gone OR p_type = 'SMALL' THEN 0 ELSE 1 END AS BIGINT) AS status,
       CAST(CASE WHEN gone OR state = 'new' OR renamed OR dearer OR p_size % 2 = 0 THEN 1 ELSE 0 END AS BIGINT) AS change, CAST(category AS BIGINT) AS category,
       CAST(CASE p_brand WHEN 'Brand#1' THEN 1 WHEN 'Brand#2' THEN 0 END AS BIGINT) AS is_master, master AS master_model, k || '.jpg' AS products_image,
       CASE WHEN p_size % 2 = 0 THEN 'T' || k WHEN renamed THEN upper(p_name) ELSE p_name END AS meta_title,
       base || CASE WHEN slot > 0 THEN '-' || slot ELSE '' END AS seo_slug FROM x""")
def stage_articles(spark, d):
    """Categories, articles and their texts, staged twice."""
    rows = _staged(spark, d, ["category", "article", "article_meta"]).read("article")
    return rows.select("id", "model", "name", "price", "tax_class_id", "status", "change", "category", "is_master", "master_model", "products_image", "meta_title", "seo_slug")


@query("stage_links", f"""
WITH {_STAGED_SQL},
t AS (SELECT name, row_number() OVER (ORDER BY field, first) AS id FROM (
        SELECT 1 AS field, CASE k % 3 WHEN 0 THEN 'Color' ELSE 'Form' END AS name, min(id) AS first FROM one WHERE k % 3 < 2 GROUP BY 2
        UNION ALL SELECT 2, 'Size', 0)),
v AS (SELECT id, CASE k % 3 WHEN 0 THEN 'Color' ELSE 'Form' END AS name, CASE WHEN k % 3 = 0 AND k % 5 = 0 THEN 'x'
             ELSE CASE WHEN p_brand = 'Brand#7' AND model LIKE 'P%' THEN 'w' ELSE 'v' END || p_size END AS value FROM w WHERE k % 3 < 2
      UNION ALL SELECT id, 'Size', CAST(p_size AS VARCHAR) FROM w
      UNION ALL SELECT id, 'Color', 'x' FROM w WHERE k % 5 = 0 AND k % 3 <> 0)
SELECT CAST(v.id AS BIGINT) AS article_id, CAST(t.id AS BIGINT) AS attribute_id, value, CAST(1 AS BIGINT) AS status FROM v JOIN t USING (name)""")
def stage_links(spark, d):
    """Articles, attributes and the links between them, staged twice."""
    names = ["article", *(f"{kind}_{i}" for i in range(1, 5) for kind in ("attribute", "article_attribute"))]
    return _staged(spark, d, names).read("article_attribute").select("article_id", "attribute_id", "value", "status")


@query("stage_media", rf"""
WITH m AS ({cat.MEDIA}),
f AS (SELECT *, regexp_extract(replace(path, '\', '/'), '([^/]*)$', 1) AS file_name, CASE kind WHEN 'image' THEN 'images' ELSE 'files' END AS type,
             CASE lang WHEN 'fr' THEN 'Category' ELSE 'Product' END AS class, row_number() OVER (ORDER BY kind DESC, path) AS place FROM m),
n AS (SELECT *, row_number() OVER (ORDER BY kind DESC, path) AS later FROM f WHERE quality = 0),
media AS (
  SELECT place AS id, 'c-' || media_id AS hash, class, type, file_name, CASE WHEN quality = 0 THEN 0 ELSE 1 END AS status, CASE WHEN quality = 0 THEN 1 ELSE 0 END AS change, 1 AS upload FROM f
  UNION ALL SELECT (SELECT count(*) FROM f) + later, 'new-' || media_id, class, type, file_name, 1, 1, 1 FROM n),
relation AS (
  SELECT file_name, CASE lang WHEN 'de' THEN 'article' ELSE 'category' END AS entity_type, CASE lang WHEN 'de' THEN CAST(media_id AS VARCHAR) ELSE source END AS entity_id,
         CASE WHEN quality = 0 THEN 'new-' ELSE 'c-' END || media_id AS hash, 1 AS status, CASE WHEN quality = 0 THEN 1 ELSE 0 END AS change FROM f WHERE kind = 'image'
  UNION ALL SELECT source || '-' || media_id || '.pdf', 'article', 'P' || (media_id % 100), NULL, CASE WHEN toxic = 1 THEN 0 ELSE 1 END, CASE WHEN toxic = 1 THEN 1 ELSE 0 END FROM m
  UNION ALL SELECT source || '-' || media_id || '.pdf', 'article', 'R' || (media_id % 100), NULL, 1, 1 FROM m WHERE toxic = 1)
SELECT 'media' AS part, CAST(id AS BIGINT) AS id, file_name, class AS kind, type AS entity, hash, CAST(status AS BIGINT) AS status, CAST(change AS BIGINT) AS change, CAST(upload AS BIGINT) AS upload FROM media
UNION ALL SELECT 'relation', NULL, file_name, entity_type, entity_id, hash, CAST(status AS BIGINT), CAST(change AS BIGINT), NULL FROM relation""")
def stage_media(spark, d):
    """Image and document files, what they belong to, and the documents of the articles, staged twice."""
    names = ["media_images", "media_documents", "media_relation_images", "media_relation_documents", "file_vault_images", "file_vault_documents"]
    store = _staged(spark, d, names)
    c = F.col
    media = store.read("media").select(
        F.lit("media").alias("part"), c("media_id").alias("id"), "file_name", c("class").alias("kind"), c("type").alias("entity"), "hash", "status", "change", "upload"
    )
    relation = store.read("media_relation").select(
        F.lit("relation").alias("part"), "file_name", c("entity_type").alias("kind"), c("entity_id").alias("entity"), "hash", "status", "change"
    )
    return media.unionByName(relation, allowMissingColumns=True)

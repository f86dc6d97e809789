"""Catalogue tables derived from the given tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .base import sql_slug, table

# Articles as the source sends them: texts with blanks, decimal commas, words for flags.
INCOMING = """
SELECT 'P' || p_partkey AS article_no,
       '  ' || p_name || ' ' AS title,
       replace(CAST(p_retailprice AS VARCHAR), '.', ',') AS price_text,
       CASE p_type WHEN 'PROMO' THEN '7' WHEN 'SMALL' THEN '0' WHEN 'LARGE' THEN '16,0' ELSE '19.00' END AS tax_text,
       CASE WHEN p_type = 'SMALL' THEN 'nein' ELSE 'ja' END AS online,
       CASE p_brand WHEN 'Brand#1' THEN 'Master' WHEN 'Brand#2' THEN 'P' || p_size ELSE '' END AS master,
       CASE p_type WHEN 'MEDIUM' THEN '' ELSE ' ' || p_type END AS category_code,
       CAST(p_size AS VARCHAR) || '.5' AS stock_text,
       p_brand AS brand
FROM part"""


def incoming(spark: SparkSession, d: str) -> DataFrame:
    kind, brand = F.col("p_type"), F.col("p_brand")
    return table(spark, d, "part").select(
        F.concat(F.lit("P"), "p_partkey").alias("article_no"),
        F.concat(F.lit("  "), "p_name", F.lit(" ")).alias("title"),
        F.replace(F.col("p_retailprice").cast("string"), F.lit("."), F.lit(",")).alias("price_text"),
        F.when(kind == "PROMO", "7").when(kind == "SMALL", "0").when(kind == "LARGE", "16,0").otherwise("19.00").alias("tax_text"),
        F.when(kind == "SMALL", "nein").otherwise("ja").alias("online"),
        F.when(brand == "Brand#1", "Master").when(brand == "Brand#2", F.concat(F.lit("P"), "p_size")).otherwise("").alias("master"),
        F.when(kind == "MEDIUM", "").otherwise(F.concat(F.lit(" "), kind)).alias("category_code"),
        F.concat(F.col("p_size").cast("string"), F.lit(".5")).alias("stock_text"),
        brand.alias("brand"),
    )


# Articles as stored by the run before: no article of the largest sizes yet, some other prices
# and names, and articles of each supplier that are no longer sent.
STORED = """
SELECT CAST(p_partkey + 1 AS BIGINT) AS id, 'P' || p_partkey AS model,
       CASE WHEN p_type = 'LARGE' THEN upper(p_name) ELSE p_name END AS name,
       p_retailprice + CASE WHEN p_brand IN ('Brand#7', 'Brand#19') THEN 1.0 ELSE 0.0 END AS price,
       CAST(CASE p_type WHEN 'PROMO' THEN 2 WHEN 'SMALL' THEN 0 WHEN 'LARGE' THEN 16 ELSE 1 END AS INTEGER) AS tax_class,
       CAST(CASE WHEN p_type = 'SMALL' THEN 0 ELSE 1 END AS INTEGER) AS status,
       CAST(CASE WHEN p_brand = 'Brand#3' THEN 1 ELSE 0 END AS INTEGER) AS change,
       CAST(CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'LARGE' THEN 2 WHEN 'PROMO' THEN 3 ELSE 0 END AS BIGINT) AS category,
       CASE WHEN p_brand IN ('Brand#4', 'Brand#5') THEN 'de/alt/' || p_partkey END AS seo_slug,
       'before' AS updated_at
FROM part WHERE p_size <= 45
UNION ALL
SELECT CAST(1000000000 + s_suppkey AS BIGINT), 'X' || s_suppkey, s_name, s_acctbal, CAST(1 AS INTEGER),
       CAST(CASE WHEN s_acctbal < 3000 THEN 0 ELSE 1 END AS INTEGER),
       CAST(CASE WHEN s_acctbal < 1000 THEN 1 ELSE 0 END AS INTEGER), CAST(0 AS BIGINT),
       'de/x-' || s_suppkey, 'before'
FROM supplier"""


def stored(spark: SparkSession, d: str) -> DataFrame:
    kind, brand = F.col("p_type"), F.col("p_brand")
    parts = table(spark, d, "part").where("p_size <= 45").select(
        (F.col("p_partkey") + 1).alias("id"),
        F.concat(F.lit("P"), "p_partkey").alias("model"),
        F.when(kind == "LARGE", F.upper("p_name")).otherwise(F.col("p_name")).alias("name"),
        (F.col("p_retailprice") + F.when(brand.isin("Brand#7", "Brand#19"), 1.0).otherwise(0.0)).alias("price"),
        F.when(kind == "PROMO", 2).when(kind == "SMALL", 0).when(kind == "LARGE", 16).otherwise(1).alias("tax_class"),
        F.when(kind == "SMALL", 0).otherwise(1).alias("status"),
        F.when(brand == "Brand#3", 1).otherwise(0).alias("change"),
        F.when(kind == "ECONOMY", 1).when(kind == "LARGE", 2).when(kind == "PROMO", 3).otherwise(0).cast("bigint").alias("category"),
        F.when(brand.isin("Brand#4", "Brand#5"), F.concat(F.lit("de/alt/"), "p_partkey")).alias("seo_slug"),
        F.lit("before").alias("updated_at"),
    )
    balance = F.col("s_acctbal")
    gone = table(spark, d, "supplier").select(
        (F.col("s_suppkey") + 1000000000).alias("id"),
        F.concat(F.lit("X"), "s_suppkey").alias("model"),
        F.col("s_name").alias("name"),
        balance.alias("price"),
        F.lit(1).alias("tax_class"),
        F.when(balance < 3000, 0).otherwise(1).alias("status"),
        F.when(balance < 1000, 1).otherwise(0).alias("change"),
        F.lit(0).cast("bigint").alias("category"),
        F.concat(F.lit("de/x-"), "s_suppkey").alias("seo_slug"),
        F.lit("before").alias("updated_at"),
    )
    return parts.unionByName(gone)


# Categories: one per kind of part that has a shop page.
CATEGORIES = """
SELECT CAST(CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'LARGE' THEN 2 WHEN 'PROMO' THEN 3 END AS BIGINT) AS id,
       p_type AS source_id, min('de/' || lower(p_type)) AS seo_slug
FROM part WHERE p_type IN ('ECONOMY', 'LARGE', 'PROMO') GROUP BY p_type"""


def categories(spark: SparkSession, d: str) -> DataFrame:
    kind = F.col("p_type")
    kinds = table(spark, d, "part").where(kind.isin("ECONOMY", "LARGE", "PROMO")).select("p_type").distinct()
    return kinds.select(
        F.when(kind == "ECONOMY", 1).when(kind == "LARGE", 2).otherwise(3).cast("bigint").alias("id"),
        kind.alias("source_id"),
        F.concat(F.lit("de/"), F.lower(kind)).alias("seo_slug"),
    )


# Category tree of regions, nations and suppliers.
TREE = """
SELECT 'R' || r_regionkey AS id, '0' AS parent, r_name AS name FROM region
UNION ALL SELECT 'N' || n_nationkey, 'R' || n_regionkey, n_name || ' & Süd' FROM nation
UNION ALL SELECT 'S' || s_suppkey, 'N' || s_nationkey, s_name FROM supplier
UNION ALL SELECT 'C' || c_custkey, 'S' || c_custkey, c_name FROM customer"""


def tree(spark: SparkSession, d: str) -> DataFrame:
    def level(name: str, key: str, prefix: str, parent, label) -> DataFrame:
        return table(spark, d, name).select(
            F.concat(F.lit(prefix), key).alias("id"), parent.alias("parent"), label.alias("name")
        )

    return (
        level("region", "r_regionkey", "R", F.lit("0"), F.col("r_name"))
        .unionByName(level("nation", "n_nationkey", "N", F.concat(F.lit("R"), "n_regionkey"), F.concat("n_name", F.lit(" & Süd"))))
        .unionByName(level("supplier", "s_suppkey", "S", F.concat(F.lit("N"), "s_nationkey"), F.col("s_name")))
        .unionByName(level("customer", "c_custkey", "C", F.concat(F.lit("S"), "c_custkey"), F.col("c_name")))
    )


# Media files, one per document.
MEDIA = """
SELECT d.doc_id AS media_id,
       CASE lang WHEN 'de' THEN 'srcFiles/Artikel/' || d.doc_id || '/' || source || '.JPG'
                 WHEN 'fr' THEN 'srcFiles\\Warengruppen\\' || source || '\\bild_' || d.doc_id || '.png'
                 WHEN 'es' THEN 'srcFiles/Warengruppen/' || source || '//artikel/A' || d.doc_id || '/x.pdf'
                 ELSE 'srcFiles/' || source || '/doc ' || d.doc_id || '.tar.gz' END AS path,
       n_chars AS size, source, lang,
       CASE WHEN lang IN ('de', 'fr') THEN 'image' ELSE 'document' END AS kind,
       quality, toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""


def media(spark: SparkSession, d: str) -> DataFrame:
    lang, doc = F.col("lang"), F.col("doc_id").cast("string")
    path = (
        F.when(lang == "de", F.concat(F.lit("srcFiles/Artikel/"), doc, F.lit("/"), "source", F.lit(".JPG")))
        .when(lang == "fr", F.concat(F.lit("srcFiles\\Warengruppen\\"), "source", F.lit("\\bild_"), doc, F.lit(".png")))
        .when(lang == "es", F.concat(F.lit("srcFiles/Warengruppen/"), "source", F.lit("//artikel/A"), doc, F.lit("/x.pdf")))
        .otherwise(F.concat(F.lit("srcFiles/"), "source", F.lit("/doc "), doc, F.lit(".tar.gz")))
    )
    return (
        table(spark, d, "documents")
        .join(table(spark, d, "labels"), "doc_id", "left")
        .select(
            F.col("doc_id").alias("media_id"), path.alias("path"), F.col("n_chars").alias("size"), "source", "lang",
            F.when(lang.isin("de", "fr"), "image").otherwise("document").alias("kind"), "quality", "toxic",
        )
    )


# Run log: events of users as entries of jobs.
LOG = """
SELECT event_id AS id, 'job' || user_id AS job,
       CASE event_type WHEN 'error' THEN 'error' WHEN 'signup' THEN 'warning' WHEN 'purchase' THEN 'notice' ELSE 'info' END AS level,
       event_type AS stage, 'value ' || CAST(value AS VARCHAR) AS message, props AS context,
       strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS created_at
FROM events"""


def log(spark: SparkSession, d: str) -> DataFrame:
    kind = F.col("event_type")
    level = F.when(kind == "error", "error").when(kind == "signup", "warning").when(kind == "purchase", "notice").otherwise("info")
    from ..functions.numbers import iso_time

    return table(spark, d, "events").select(
        F.col("event_id").alias("id"),
        F.concat(F.lit("job"), "user_id").alias("job"),
        level.alias("level"),
        kind.alias("stage"),
        F.concat(F.lit("value "), F.col("value").cast("string")).alias("message"),
        F.col("props").alias("context"),
        iso_time(F.col("ts")).alias("created_at"),
    )


SLUG_OF_PART = sql_slug("p_name")

"""Queries for the shop export."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..operators import sync
from ..operators.schema import create_table
from ..sources.snapshots import SnapshotStore
from . import catalog as cat
from .base import query, scratch, table
from .shop_export import SHOP_TABLES, shop_entities, shop_sources, shop_table

NOW = "2024-06-01T00:00:00+00:00"


def _earlier(rows, **columns):
    """Rows as an earlier run has seen them."""
    return rows.withColumns(columns)


def staging(spark, d, earlier: bool = False) -> dict:
    """Staging tables as the export reads them, or as they were before: other numbers, prices, names and states."""
    c, stored = F.col, cat.stored(spark, d)
    if earlier:
        cheap = c("tax_class") == 2
        stored = _earlier(
            stored, price=c("price") + F.when(cheap, 1.0).otherwise(0.0), category=c("category") + F.when(cheap, 10).otherwise(0),
            name=F.when(cheap, F.concat("name", F.lit(" alt"))).otherwise(c("name")), model=F.regexp_replace("model", "^X", "Z"),
        )
    article = stored.select(
        "model", "name", "status", "price", F.col("tax_class").alias("tax_class_id"), "category", "seo_slug", "updated_at",
        F.lit(" ").alias("ean"), F.lit("1,5").alias("gross_weight"), F.lit(None).cast("int").alias("is_master"),
        F.lit("").alias("master_model"), F.concat("model", F.lit(".jpg")).alias("products_image"),
        F.col("name").alias("products_name"), F.upper("name").alias("products_description"), F.lit("").alias("promo_html"),
        F.col("name").alias("meta_title"), F.lit(None).cast("string").alias("meta_description"),
    )
    nodes = cat.tree(spark, d)
    if earlier:
        nodes = _earlier(nodes, id=F.regexp_replace("id", "^S", "U"), name=F.when(c("id").startswith("N"), F.lower("name")).otherwise(c("name")))
    category = nodes.select(
        F.col("id").alias("cat_id"), "name", F.lit(1).alias("status"), F.lit("2.7").alias("level"), F.lit(" ").alias("image"),
        F.col("name").alias("description"), F.lit("").alias("description_html"), F.lit("before").alias("updated_at"),
    )
    files = cat.media(spark, d)
    if earlier:
        files = _earlier(files, source=F.when(c("quality") == 0, F.concat(F.lit("old-"), "source")).otherwise(c("source")), toxic=F.lit(1))
    media = files.select(
        "media_id", F.concat("source", F.lit("-"), F.col("media_id").cast("string")).alias("file_name"),
        F.when(F.col("quality") == 1, F.col("source")).otherwise(" ").alias("stored_file"), "kind",
        F.coalesce("toxic", F.lit(0)).alias("status"), F.lit("before").alias("updated_at"),
    )
    relation = files.select(
        F.col("media_id").alias("relation_id"), F.concat("source", F.lit("-"), F.col("media_id").cast("string")).alias("file_name"),
        F.when(F.col("kind") == "image", "article").otherwise("category").alias("entity_type"),
        F.concat(F.lit(" E"), F.col("size").cast("string")).alias("entity_id"), F.col("quality").alias("position"),
    )
    return {"article": article, "category": category, "media": media, "media_relation": relation}


def _exported(spark, d, entities, name):
    """Export into empty shop tables, through the snapshot store; the table as stored."""
    store = SnapshotStore(spark, scratch(spark, "shop"))
    for shop in {s.target for s in shop_entities(NOW) if s.name in entities}:
        store.write(shop, create_table(spark, shop_table(shop)))
    _run(spark, store, staging(spark, d), entities)
    return store.read(name)


def _run(spark, store, tables: dict, entities: list[str] | None = None, now: str = NOW) -> None:
    """An export; an entity that fails ends it."""
    stats = sync.run_entities(spark, shop_entities(now), shop_sources(tables), store, entities)
    failed = stats.where("error is not null").first()
    if failed:
        raise RuntimeError(f"{failed['entity']}: {failed['error']}")


@query("export_products", f"""
WITH a AS ({cat.STORED})
SELECT model AS products_id, model AS external_id, model AS products_model, '1' AS products_owner, '1' AS permission_id,
       CAST(status AS VARCHAR) AS products_status, CAST(price AS VARCHAR) AS products_price, CAST(tax_class AS VARCHAR) AS products_tax_class_id,
       '1.5' AS products_weight, CAST(NULL AS VARCHAR) AS products_master_flag, CAST(NULL AS VARCHAR) AS products_master_model,
       model || '.jpg' AS products_image, '0' AS products_quantity, 'stk' AS products_unit, CAST(NULL AS VARCHAR) AS products_ean,
       '{NOW}' AS date_added, '{NOW}' AS last_modified FROM a""")
def export_products(spark, d):
    return _exported(spark, d, ["products"], "products")


@query("export_links", f"""
WITH m AS ({cat.MEDIA}),
r AS (SELECT source || '-' || media_id AS file_name, kind, 'E' || size AS entity, quality FROM m)
SELECT CASE kind WHEN 'image' THEN 'prod- ' ELSE 'cat- ' END || entity || '-' || file_name AS ml_id, file_name AS m_id, entity AS link_id,
       CASE kind WHEN 'image' THEN 'product' ELSE 'category' END AS class, 'image' AS type, CAST(quality AS VARCHAR) AS sort_order FROM r""")
def export_links(spark, d):
    return _exported(spark, d, ["media_link_products", "media_link_categories"], "media_link")


@query("export_media", f"""
WITH m AS ({cat.MEDIA})
SELECT source || '-' || media_id AS id, source || '-' || media_id AS external_id, CASE WHEN quality = 1 THEN source END AS file, kind AS type,
       CASE kind WHEN 'document' THEN 'media' ELSE 'product' END AS class, CAST(coalesce(toxic, 0) AS VARCHAR) AS status, '0' AS download_status,
       '1' AS owner, '{NOW}' AS date_added, '{NOW}' AS last_modified FROM m""")
def export_media(spark, d):
    return _exported(spark, d, ["media"], "media")


@query("export_all", f"""
WITH a AS ({cat.STORED}), t AS ({cat.TREE}), m AS ({cat.MEDIA})
SELECT 'categories' AS "table", CAST(count(*) AS BIGINT) AS rows FROM t UNION ALL SELECT 'categories_description', CAST(count(*) AS BIGINT) FROM t
UNION ALL SELECT 'products', CAST(count(*) AS BIGINT) FROM a UNION ALL SELECT 'products_description', CAST(count(*) AS BIGINT) FROM a
UNION ALL SELECT 'products_to_categories', CAST(count(*) AS BIGINT) FROM a UNION ALL SELECT 'seo_url', CAST(count(DISTINCT seo_slug) AS BIGINT) FROM a
UNION ALL SELECT 'media', CAST(count(*) AS BIGINT) FROM m UNION ALL SELECT 'media_description', CAST(count(*) AS BIGINT) FROM m
UNION ALL SELECT 'media_link', CAST(count(*) AS BIGINT) FROM m""")
def export_all(spark, d):
    """All ten entities; rows per shop table afterwards."""
    from ..operators.schema import table_counts

    store = SnapshotStore(spark, scratch(spark, "shop"))
    for name in SHOP_TABLES:
        store.write(name, create_table(spark, shop_table(name)))
    _run(spark, store, staging(spark, d))
    return table_counts(store.tables())


LATER = "2024-06-02T00:00:00+00:00"

# Both states of the staging tables: what the first export wrote, and what the second wrote over it.
_STATES_SQL = f"""
n AS ({cat.STORED}),
o AS (SELECT regexp_replace(model, '^X', 'Z') AS model, CASE WHEN tax_class = 2 THEN name || ' alt' ELSE name END AS name, price + CASE WHEN tax_class = 2 THEN 1.0 ELSE 0.0 END AS price,
             tax_class, status, CASE WHEN tax_class = 2 THEN category + 10 ELSE category END AS category, seo_slug FROM n),
a AS (SELECT model, name, price, tax_class, status, category, seo_slug, 'now' AS state, model IN (SELECT model FROM o) AS known FROM n
      UNION ALL SELECT model, name, price, tax_class, status, category, seo_slug, 'gone', true FROM o WHERE model NOT IN (SELECT model FROM n)),
t AS ({cat.TREE}),
ot AS (SELECT regexp_replace(id, '^S', 'U') AS id, CASE WHEN id LIKE 'N%' THEN lower(name) ELSE name END AS name FROM t),
k AS (SELECT id, name, 'now' AS state, id IN (SELECT id FROM ot) AS known FROM t UNION ALL SELECT id, name, 'gone', true FROM ot WHERE id NOT IN (SELECT id FROM t)),
m AS ({cat.MEDIA}),
f AS (SELECT source || '-' || media_id AS file, CASE WHEN quality = 1 THEN source END AS stored, kind, coalesce(toxic, 0) AS status, size, quality, 'now' AS state, quality IS DISTINCT FROM 0 AS known FROM m
      UNION ALL SELECT 'old-' || source || '-' || media_id, NULL, kind, 1, size, quality, 'gone', true FROM m WHERE quality = 0)"""

_ADDED = f"CASE state WHEN 'gone' THEN '{NOW}' ELSE CASE WHEN known THEN 'before' ELSE '{LATER}' END END AS date_added, '{LATER}' AS last_modified"
_FILLED_SQL = {
    "products": f"""
SELECT model AS products_id, model AS external_id, model AS products_model, 1 AS products_owner, 1 AS permission_id, CASE state WHEN 'gone' THEN 0 ELSE status END AS products_status,
       price AS products_price, tax_class AS products_tax_class_id, 1.5 AS products_weight, NULL AS products_master_flag, NULL AS products_master_model,
       model || '.jpg' AS products_image, 0 AS products_quantity, 'stk' AS products_unit, NULL AS products_ean, {_ADDED} FROM a""",
    "products_description": """
SELECT model AS products_id, 'de' AS language_code, name AS products_name, upper(name) AS products_description, NULL AS products_short_description, name AS products_keywords,
       seo_slug AS products_url, 1 AS products_store_id FROM a""",
    "products_to_categories": """
SELECT model AS products_id, category AS categories_id, NULL AS master_link, 1 AS store_id FROM (SELECT model, category FROM n UNION SELECT model, category FROM o)""",
    "seo_url": """
SELECT seo_slug AS url_md5, seo_slug AS url_text, 'de' AS language_code, 'product' AS link_type, model AS link_id, name AS meta_title, NULL AS meta_description, name AS meta_keywords,
       1 AS store_id FROM n WHERE seo_slug IS NOT NULL""",
    "categories": f"""
SELECT id AS categories_id, id AS external_id, 1 AS categories_owner, 1 AS permission_id, 2 AS categories_level, CASE state WHEN 'gone' THEN 0 ELSE 1 END AS categories_status,
       NULL AS categories_image, 'default' AS categories_template, 'default' AS listing_template, 0 AS category_custom_link_type, 0 AS category_custom_link_id,
       id AS google_product_cat, {_ADDED} FROM k""",
    "categories_description": """
SELECT id AS categories_id, 'de' AS language_code, name AS categories_name, name AS categories_heading_title, NULL AS categories_description,
       name AS categories_description_bottom, 1 AS categories_store_id FROM k""",
    "media": f"""
SELECT file AS id, file AS external_id, stored AS file, kind AS type, CASE kind WHEN 'document' THEN 'media' ELSE 'product' END AS class, CASE state WHEN 'gone' THEN 0 ELSE status END AS status,
       0 AS download_status, 1 AS owner, {_ADDED} FROM f""",
    "media_description": "SELECT file AS id, 'de' AS language_code, file AS media_name, file AS media_description FROM f",
    "media_link": """
SELECT CASE kind WHEN 'image' THEN 'prod- ' ELSE 'cat- ' END || 'E' || size || '-' || file AS ml_id, file AS m_id, 'E' || size AS link_id,
       CASE kind WHEN 'image' THEN 'product' ELSE 'category' END AS class, 'image' AS type, quality AS sort_order FROM f""",
}


def _content_sql(name: str) -> str:
    columns = SHOP_TABLES[name][1].split()
    cells = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '~')" for c in columns)
    return f"SELECT '{name}' AS \"table\", {columns[0]} AS key, array_to_string([{cells}], '|') AS content FROM ({_FILLED_SQL[name]})"


@query("export_filled", f"WITH {_STATES_SQL} " + " UNION ALL ".join(map(_content_sql, SHOP_TABLES)))
def export_filled(spark, d):
    """All ten entities over filled shop tables: changed, new and vanished rows; contents of all nine tables."""
    store = SnapshotStore(spark, scratch(spark, "shop"))
    for name in SHOP_TABLES:
        store.write(name, create_table(spark, shop_table(name)))
    _run(spark, store, staging(spark, d, earlier=True))
    _run(spark, store, staging(spark, d), now=LATER)
    found = []
    for name, (_, columns) in SHOP_TABLES.items():
        cells = [F.coalesce(c, F.lit("~")) for c in columns.split()]
        found.append(store.read(name).select(F.lit(name).alias("table"), F.col(columns.split()[0]).alias("key"), F.concat_ws("|", *cells).alias("content")))
    return reduce(DataFrame.unionByName, found)

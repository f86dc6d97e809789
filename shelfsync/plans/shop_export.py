"""Export of the catalogue to the tables of a shop: ten entities, nine tables.

Every shop column is text. Sources are the staging tables ``category``, ``article`` and
``media``, and ``media_relation`` read once per kind of owner.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.logic import case
from ..functions.numbers import to_decimal, to_int
from ..functions.text import concat, null_if_empty, trim
from ..operators.orphans import OrphanPolicy
from ..operators.schema import TargetTable
from ..operators.sync import EntitySpec

# Shop tables, their keys and the columns the export writes.
SHOP_TABLES = {
    "categories": (
        ["external_id"],
        "categories_id external_id categories_owner permission_id categories_level categories_status categories_image "
        "categories_template listing_template category_custom_link_type category_custom_link_id google_product_cat "
        "date_added last_modified",
    ),
    "categories_description": (
        ["categories_id", "language_code"],
        "categories_id language_code categories_name categories_heading_title categories_description "
        "categories_description_bottom categories_store_id",
    ),
    "products": (
        ["external_id"],
        "products_id external_id products_model products_owner permission_id products_status products_price "
        "products_tax_class_id products_weight products_master_flag products_master_model products_image products_quantity "
        "products_unit products_ean date_added last_modified",
    ),
    "products_description": (
        ["products_id", "language_code"],
        "products_id language_code products_name products_description products_short_description products_keywords "
        "products_url products_store_id",
    ),
    "products_to_categories": (["products_id", "categories_id"], "products_id categories_id master_link store_id"),
    "seo_url": (
        ["url_md5"],
        "url_md5 url_text language_code link_type link_id meta_title meta_description meta_keywords store_id",
    ),
    "media": (["external_id"], "id external_id file type class status download_status owner date_added last_modified"),
    "media_description": (["id", "language_code"], "id language_code media_name media_description"),
    "media_link": (["m_id", "link_id", "class", "type"], "ml_id m_id link_id class type sort_order"),
}


# Order in which each staging table is read; of rows with one key the last wins.
SOURCE_ORDER = {
    "category": ("cat_id",),
    "article": ("model",),
    "media": ("media_id",),
    "media_relation_articles": ("relation_id",),
    "media_relation_categories": ("relation_id",),
}


def shop_table(name: str) -> TargetTable:
    keys, fields = SHOP_TABLES[name]
    return TargetTable(name, fields.split(), unique_constraint=keys)


def shop_entities(now: str, language: str = "de") -> list[EntitySpec]:
    """The entities in the order they run. ``now`` is the time of the run as text."""
    c = F.col
    key = lambda name: trim(c(name).cast("string"))
    filled = lambda name: null_if_empty(c(name))
    stamped = {"on_insert": {"date_added": now, "last_modified": now}, "on_changed": {"last_modified": now}}

    def switched_off(status: str) -> tuple[OrphanPolicy, ...]:
        return (OrphanPolicy(("external_id",), {status: "0", "last_modified": now}),)

    def entity(name: str, source: str, target: str, columns: dict, delta: Sequence[str] = (), **rest) -> EntitySpec:
        keys = shop_table(target).merge_keys()
        return EntitySpec(name, source, target, columns, keys, delta, order=SOURCE_ORDER[source], **rest)

    def media_links(name: str, source: str, owner: str, prefix: str, **rest) -> EntitySpec:
        return entity(
            name, source, "media_link",
            {
                "ml_id": concat(F.lit(prefix), c("entity_id"), F.lit("-"), c("file_name")),
                "m_id": key("file_name"),
                "link_id": key("entity_id"),
                "class": owner,
                "type": "image",
                "sort_order": to_int(c("position")),
            },
            ["link_id"], **rest,
        )

    return [
        entity(
            "categories", "category", "categories",
            {
                "categories_id": key("cat_id"), "external_id": key("cat_id"), "categories_owner": 1, "permission_id": 1,
                "categories_level": to_int(c("level")), "categories_status": to_int(c("status")),
                "categories_image": filled("image"), "categories_template": "default", "listing_template": "default",
                "category_custom_link_type": 0, "category_custom_link_id": 0, "google_product_cat": key("cat_id"),
                "date_added": filled("updated_at"), "last_modified": filled("updated_at"),
            },
            ["categories_level", "categories_status", "categories_image", "date_added", "last_modified"],
            orphans=switched_off("categories_status"), **stamped,
        ),
        entity(
            "categories_description", "category", "categories_description",
            {
                "categories_id": key("cat_id"), "language_code": language, "categories_name": filled("name"),
                "categories_heading_title": filled("name"), "categories_description": filled("description_html"),
                "categories_description_bottom": filled("description"), "categories_store_id": 1,
            },
            ["categories_name", "categories_description", "categories_description_bottom"],
        ),
        entity(
            "products", "article", "products",
            {
                "products_id": key("model"), "external_id": key("model"), "products_model": key("model"),
                "products_owner": 1, "permission_id": 1, "products_status": to_int(c("status")),
                "products_price": to_decimal(c("price")), "products_tax_class_id": to_int(c("tax_class_id")),
                "products_weight": to_decimal(c("gross_weight")), "products_master_flag": to_int(c("is_master")),
                "products_master_model": filled("master_model"), "products_image": filled("products_image"),
                "products_quantity": 0, "products_unit": "stk", "products_ean": filled("ean"),
                "date_added": filled("updated_at"), "last_modified": filled("updated_at"),
            },
            ["products_status", "products_price", "products_tax_class_id", "products_weight", "products_image", "last_modified"],
            orphans=switched_off("products_status"), **stamped,
        ),
        entity(
            "products_description", "article", "products_description",
            {
                "products_id": key("model"), "language_code": language, "products_name": filled("products_name"),
                "products_description": filled("products_description"), "products_short_description": filled("promo_html"),
                "products_keywords": filled("name"), "products_url": filled("seo_slug"), "products_store_id": 1,
            },
            ["products_name", "products_description", "products_short_description", "products_keywords", "products_url"],
        ),
        entity(
            "products_to_categories", "article", "products_to_categories",
            {
                "products_id": key("model"), "categories_id": key("category"), "master_link": to_int(c("is_master")), "store_id": 1,
            },
        ),
        entity(
            "seo_url", "article", "seo_url",
            {
                "url_md5": key("seo_slug"), "url_text": key("seo_slug"), "language_code": language, "link_type": "product",
                "link_id": key("model"), "meta_title": filled("meta_title"), "meta_description": filled("meta_description"),
                "meta_keywords": filled("name"), "store_id": 1,
            },
        ),
        entity(
            "media", "media", "media",
            {
                "id": key("file_name"), "external_id": key("file_name"), "file": filled("stored_file"), "type": c("kind"),
                "class": case(c("kind"), {"document": "media"}, "product"), "status": to_int(c("status")),
                "download_status": 0, "owner": 1, "date_added": filled("updated_at"), "last_modified": filled("updated_at"),
            },
            ["file", "class", "status", "last_modified"],
            orphans=switched_off("status"), **stamped,
        ),
        entity(
            "media_description", "media", "media_description",
            {
                "id": key("file_name"), "language_code": language, "media_name": filled("file_name"),
                "media_description": filled("file_name"),
            },
        ),
        media_links(
            "media_link_products", "media_relation_articles", "product", "prod-",
            orphans=(OrphanPolicy(("ml_id",), {"type": "image"}),),
        ),
        media_links("media_link_categories", "media_relation_categories", "category", "cat-"),
    ]


def shop_sources(staging: Mapping[str, DataFrame]) -> dict:
    """Named sources of the export; each is read when its entity runs."""
    relation = staging["media_relation"]
    return {
        "category": lambda: staging["category"],
        "article": lambda: staging["article"],
        "media": lambda: staging["media"],
        "media_relation_articles": lambda: relation.where("entity_type = 'article'"),
        "media_relation_categories": lambda: relation.where("entity_type = 'category'"),
    }

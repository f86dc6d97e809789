"""The staging run: articles, categories, media and attributes from the source system.

Source columns carry the names of the source system. ``stage_entities`` lists the jobs;
``run_order`` of the sync operators puts categories and articles first.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from ..functions.logic import (
    article_master_flag,
    article_master_number,
    case,
    coalesce,
    document_guard,
    image_guard,
    master_first,
    media_detect_type,
    media_entity_id,
    media_entity_type,
)
from ..functions.numbers import bool_to_int, round_n, tax_map, to_decimal, to_int
from ..functions.rtf import rtf_to_html
from ..functions.text import basename, meta_default, null_if_empty, trim
from ..operators.lookups import article_slug, resolve_fk
from ..operators.mapping import fill_file_name
from ..operators.ordering import first_wins, number_narrow
from ..operators.orphans import OrphanPolicy
from ..operators.schema import Field, TargetTable
from ..operators.sync import EntitySpec
from ..operators.tree import category_slug

_INT, _REAL = Field("integer"), Field("real")


def _texts(names: str) -> dict[str, Field]:
    return {n: Field() for n in names.split()}


_VAULT = _texts("file_name checksum md5") | {"size": _INT} | _texts("mtime ext mime source_path stored_file stored_path stored_at") | {"change": _INT} | _texts("updated_at")

# Staging tables with their keys.
STAGING_TABLES = {
    t.name: t
    for t in (
        TargetTable(
            "article",
            {"id": Field("integer", auto_increment=True)} | _texts("source_id shop_id model name ean description_html promo_html note_html unit")
            | {"gross_weight": _REAL, "price": _REAL, "tax_class_id": _INT, "stock": _INT, "status": _INT}
            | _texts("meta_title meta_description") | {"change": _INT, "category": _INT, "is_master": _INT}
            | _texts("master_model products_image products_name products_description seo_slug source_hash updated_at"),
            primary_key=["id"], business_key=["model"], unique_constraint=["model"],
        ),
        TargetTable(
            "category",
            {"id": Field("integer", auto_increment=True), "source_id": _INT} | _texts("shop_id name level attachment parent_id") | {"status": _INT}
            | _texts("image image_large description_html description meta_description meta_title seo_slug") | {"change": _INT}
            | _texts("source_hash updated_at"),
            primary_key=["id"], business_key=["source_id"], unique_constraint=["source_id"],
        ),
        TargetTable(
            "media",
            {"media_id": Field("integer", auto_increment=True)} | _texts("file_name stored_file stored_path mime") | {"file_size": _INT}
            | _texts("hash class type") | {"status": Field("integer", 1), "change": Field("integer", 0), "upload": Field("integer", 0)}
            | _texts("stored_at updated_at"),
            primary_key=["media_id"], business_key=["hash", "class", "type"],
        ),
        TargetTable(
            "media_relation",
            {"relation_id": Field("integer", auto_increment=True)} | _texts("file_name entity_type entity_id hash")
            | {"position": Field("integer", 0), "status": Field("integer", 1), "change": Field("integer", 0)} | _texts("updated_at"),
            primary_key=["relation_id"], unique_constraint=["file_name", "entity_type", "entity_id"],
        ),
        TargetTable("attribute", {"id": Field("integer", auto_increment=True), "shop_id": _INT} | _texts("name updated_at"), keys=["name"]),
        TargetTable(
            "article_attribute", {"article_id": _INT, "attribute_id": _INT, "status": _INT} | _texts("value updated_at"),
            keys=["article_id", "attribute_id"],
        ),
        TargetTable("file_vault_images", _VAULT, keys=["file_name"]),
        TargetTable("file_vault_documents", _VAULT, keys=["file_name"]),
    )
}

# Attribute name column and its value column in the article source.
ATTRIBUTE_COLUMNS = {1: ("Zusatzfeld03", "Zusatzfeld15"), 2: ("Zusatzfeld04", "Zusatzfeld16"), 3: ("Zusatzfeld05", "Zusatzfeld17"), 4: ("Zusatzfeld06", "Zusatzfeld18")}


def article_run_order(articles: DataFrame) -> DataFrame:
    """Article source with its run order: masters and single articles before variants."""
    return number_narrow(articles.withColumn("__rank", master_first(F.col("Zusatzfeld07"))), ["__rank", "Artikelnummer"], "ordinal").drop("__rank")


def _article_links(rows: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    with_slug = article_slug(rows, tables["article"], tables["category"], "model", "category", "name", "master_model", "seo_slug")
    return resolve_fk(with_slug, "category", tables["category"], "source_id", on_missing="default")


def _category_links(rows: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    return category_slug(rows, "seo_slug", tables["category_paths"])


def _attribute_links(rows: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    with_article = resolve_fk(rows, "article_id", tables["article"], "model")
    return resolve_fk(with_article, "attribute_id", tables["attribute"], "name")


def stage_entities(now: str, article_suffix: str = "", category_title_suffix: str = "", category_suffix: str = "") -> list[EntitySpec]:
    """All staging jobs. The suffixes end the default meta texts of the shop."""
    c = F.col
    tidy = lambda name: null_if_empty(trim(c(name).cast("string")))
    file = lambda name: null_if_empty(basename(c(name)))
    rich = lambda name: rtf_to_html(c(name))
    touched = {"change": 1, "updated_at": now}
    flags = {"on_insert": touched, "on_changed": touched, "on_unchanged": {"change": 0}}
    off = {"status": 0, "change": 1}

    def entity(name: str, source: str, target: str, columns: dict, delta: str, **rest) -> EntitySpec:
        table = STAGING_TABLES[target]
        surrogate = next((n for n, f in table.definitions().items() if f.auto_increment), None)
        return EntitySpec(name, source, target, columns, table.merge_keys(), delta.split(), surrogate=surrogate, **rest)

    def vault(name: str, source: str, target: str) -> EntitySpec:
        same = "checksum size mime source_path stored_file stored_path stored_at".split()
        return entity(
            name, source, target, {"file_name": trim(c("file_name")), **{n: c(n) for n in same}, "change": 0},
            "checksum size stored_file stored_path stored_at", order=("source_path",), **flags,
        )

    def media(name: str, source: str, guard, kind: str) -> EntitySpec:
        uploaded = {"change": 1, "upload": 1, "updated_at": now}
        return entity(
            name, source, "media",
            {
                "file_name": guard(c("mime"), coalesce(c("file_name"), c("stored_file"), c("checksum"))),
                "mime": c("mime"), "file_size": c("size"),
                "hash": guard(c("mime"), coalesce(c("checksum"), c("file_name"), c("stored_file"))),
                "stored_file": c("stored_file"), "stored_path": c("stored_path"), "stored_at": c("stored_at"),
                "class": case(media_detect_type(c("source_path")), {1: "Product", 2: "Category"}, "Product"),
                "type": kind, "status": 1, "change": 0,
            },
            "file_name mime file_size stored_file stored_path class type",
            on_insert=uploaded, on_changed=uploaded, on_unchanged={"change": 0}, order=("source_path",),
            prepare=lambda rows, tables: fill_file_name(rows),
            orphans=(OrphanPolicy(("hash", "class", "type"), off, scope=c("type") == kind),),
        )

    specs = [
        entity(
            "category", "category", "category",
            {
                "source_id": to_int(c("Warengruppe")), "name": tidy("Bezeichnung"), "level": c("Ebene"), "attachment": c("Anhang"),
                "parent_id": F.when(c("Anhang").cast("string") != "0", c("Anhang")),
                "description_html": rich("Beschreibung"), "description": rich("Beschreibung"), "status": bool_to_int(c("Internet")),
                "image": file("Bild"), "image_large": file("Bild_gross"),
                "meta_title": meta_default(c("Bezeichnung"), category_title_suffix),
                "meta_description": meta_default(c("Bezeichnung"), category_suffix), "source_hash": c("Update"),
                "seo_slug": c("Warengruppe"), "change": 0,
            },
            "name level attachment parent_id description_html description status image image_large meta_title meta_description seo_slug source_hash",
            enrich=_category_links, slug="seo_slug", ordinal="ordinal", order=("ordinal",), **flags,
        ),
        entity(
            "article", "article", "article",
            {
                "model": trim(c("Artikelnummer")), "source_id": tidy("Artikel"), "name": tidy("Bezeichnung"), "ean": c("EANNummer"),
                "description_html": rich("Langtext"), "promo_html": rich("Werbetext1"), "note_html": rich("Bemerkung"),
                "unit": tidy("Einheit"), "gross_weight": to_decimal(c("Bruttogewicht")), "price": round_n(to_decimal(c("VK3")), 2),
                "tax_class_id": tax_map(c("Umsatzsteuer")), "stock": to_int(c("Bestand")), "status": bool_to_int(c("Internet")),
                "category": c("Warengruppe"), "seo_slug": F.lit(None).cast("string"),
                "meta_title": meta_default(c("Bezeichnung")), "meta_description": meta_default(c("Bezeichnung"), article_suffix),
                "is_master": article_master_flag(c("Zusatzfeld07")), "master_model": article_master_number(c("Zusatzfeld07")),
                "products_image": file("Bild1"), "products_name": tidy("Bezeichnung"), "products_description": rich("Langtext"),
                "source_hash": c("Update"), "change": 0,
            },
            "name ean description_html promo_html note_html unit gross_weight price tax_class_id stock status category seo_slug "
            "is_master master_model products_image products_name products_description source_hash",
            enrich=_article_links, slug="seo_slug", ordinal="ordinal", order=("ordinal",),
            orphans=(OrphanPolicy(("model",), off),), **flags,
        ),
        entity(
            "article_meta", "article_texts", "article",
            {"model": trim(c("Artikelnummer")), "meta_title": tidy("Meta_Title"), "meta_description": tidy("Meta_Description")},
            "meta_title meta_description", on_insert=touched, on_changed=touched,
        ),
        media("media_images", "image_vault", image_guard, "images"),
        media("media_documents", "document_vault", document_guard, "files"),
        entity(
            "media_relation_images", "image_vault", "media_relation",
            {
                "file_name": c("file_name"), "entity_type": media_entity_type(c("art_type"), c("art_id"), c("cat_id")),
                "entity_id": media_entity_id(c("art_type"), c("art_id"), c("cat_id")), "hash": image_guard(c("mime"), c("checksum")),
                "position": 0, "status": 1, "change": 0,
            },
            "entity_type entity_id hash", order=("source_path",),
            orphans=(OrphanPolicy(("file_name", "entity_type", "entity_id"), off, scope=c("hash").isNotNull()),), **flags,
        ),
        entity(
            "media_relation_documents", "document", "media_relation",
            {
                "file_name": file("Titel"), "entity_type": "article", "entity_id": tidy("Artikel"), "position": 0, "status": 1, "change": 0,
            },
            "entity_id", order=("Zaehler",),
            orphans=(OrphanPolicy(("file_name", "entity_type", "entity_id"), off, scope=c("hash").isNull()),), **flags,
        ),
        vault("file_vault_images", "image_vault", "file_vault_images"),
        vault("file_vault_documents", "document_vault", "file_vault_documents"),
    ]
    for number, (name, value) in ATTRIBUTE_COLUMNS.items():
        specs.append(
            entity(
                f"attribute_{number}", "article", "attribute", {"name": tidy(name), "updated_at": now}, "name",
                prepare=lambda rows, tables: first_wins(rows, ["name"], ["__o0"]), order=("ordinal",),
            )
        )
        specs.append(
            entity(
                f"article_attribute_{number}", "article", "article_attribute",
                {"article_id": tidy("Artikelnummer"), "attribute_id": tidy(name), "value": tidy(value), "status": 1, "updated_at": now},
                "value", prepare=_attribute_links, order=("ordinal",),
            )
        )
    return specs

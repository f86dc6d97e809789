"""Foreign keys and other lookups as left joins.

No join carries a broadcast hint: Spark broadcasts a dimension when its measured size allows
and otherwise shuffles, where adaptive execution splits hot keys of the large side. Every
dimension is reduced to one row per key first, so a lookup never multiplies rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.logic import article_master_number
from ..functions.rtf import rtf_to_html
from ..functions.text import fill_placeholder, is_blank, normalize_key, slugify, trim


def lookup_key(c: Column) -> Column:
    """Trimmed text, null when blank: a blank key finds nothing."""
    text = trim(c.cast("string"))
    return F.when(text != "", text)


def one_per_key(dim: DataFrame, key: Column, **values: Column) -> DataFrame:
    """Dimension with one row per key; of several rows the smallest values win."""
    rows = dim.select(key.alias("__key"), *[c.alias(n) for n, c in values.items()]).where(F.col("__key").isNotNull())
    if len(values) == 1:
        return rows.groupBy("__key").agg(*[F.min(n).alias(n) for n in values])
    best = rows.groupBy("__key").agg(F.min(F.struct(*values)).alias("__row"))
    return best.select("__key", *[F.col(f"__row.{n}").alias(n) for n in values])


def _short_columns(df: DataFrame) -> list[str]:
    """Columns that tell rows apart at little cost: all but texts and nested values, and the first text, mostly a key."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.NumericType, T.DatetimeType))] + texts[:1] or df.columns[:1]


def spread_blanks(df: DataFrame, key: Column) -> Column:
    """Join key in which blank keys are spread over many values that no dimension holds.

    A left join sends all null keys to one task; trimmed keys never start with a zero byte.
    """
    part = F.pmod(F.xxhash64(*_short_columns(df)), F.lit(4096)).cast("string")
    return F.coalesce(key, F.concat(F.lit("\0"), part))


def resolve_fk(
    df: DataFrame,
    column: str,
    dim: DataFrame,
    key: str,
    id_column: str = "id",
    on_missing: str = "null",
    default: Any = 0,
) -> DataFrame:
    """Replace a natural key by the id of its dimension row.

    ``on_missing``: ``null``, ``default`` or ``keep`` (the original text stays, ids become text).
    """
    ids = one_per_key(dim, lookup_key(F.col(key)), __id=F.col(id_column))
    joined = df.join(ids, spread_blanks(df, lookup_key(df[column])) == F.col("__key"), "left")
    found = F.col("__id")
    result = {
        "null": lambda: found,
        "default": lambda: F.coalesce(found, F.lit(default).cast(dim.schema[id_column].dataType)),
        "keep": lambda: F.coalesce(found.cast("string"), df[column].cast("string")),
    }[on_missing]()
    return joined.select(*[result.alias(c) if c == column else df[c] for c in df.columns])


def article_slug(
    changes: DataFrame,
    articles: DataFrame,
    categories: DataFrame,
    model: str = "model",
    category: str = "category",
    name: str = "name",
    master: str = "master",
    into: str = "seo_slug",
    root: str = "de",
) -> DataFrame:
    """Wanted slug of each article, read against the tables as they were before the run.

    A stored slug stays. Otherwise it is the slug of the category (of the master article's
    category for a variant) and the slug of the name, below ``root`` without a category.
    ``articles`` has model, category (id) and seo_slug; ``categories`` has id, source_id, seo_slug.
    """
    stored = one_per_key(articles, lookup_key(F.col("model")), __own=F.col("seo_slug"))
    masters = one_per_key(articles, lookup_key(F.col("model")), __master_category=F.col("category").cast("bigint"))
    by_code = one_per_key(categories, lookup_key(F.col("source_id")), __category=F.col("id").cast("bigint"))
    by_id = categories.select(F.col("id").cast("bigint").alias("__id"), trim(F.col("seo_slug")).alias("__path"))
    named_master = article_master_number(F.col(master))
    rows = (
        changes.join(stored, spread_blanks(changes, lookup_key(changes[model])) == stored["__key"], "left")
        .drop("__key")
        .join(masters, spread_blanks(changes, named_master) == masters["__key"], "left")
        .drop("__key")
        .join(by_code, spread_blanks(changes, lookup_key(changes[category])) == by_code["__key"], "left")
        .drop("__key")
        .withColumn("__use", F.coalesce("__master_category", "__category"))
    )
    rows = rows.join(by_id, rows["__use"] == by_id["__id"], "left")
    path = F.trim(F.col("__path"), F.lit("/"))
    folder = F.when(is_blank(path), root).otherwise(path)
    words = slugify(F.col(name), translit=False)
    fresh = F.concat_ws("/", folder, F.when(words != "", words))
    slug = F.when(~is_blank(F.col("__own")), trim(F.col("__own"))).otherwise(fresh)
    return rows.select(*[changes[c] for c in changes.columns if c != into], slug.alias(into))


def category_meta(
    df: DataFrame,
    texts: DataFrame,
    name: str,
    text_name: str,
    field: str,
    fallback: str,
    into: str,
    rich_fallback: bool = False,
) -> DataFrame:
    """Text kept for a category under its name, or the fallback column.

    Names match by their normalised key. Placeholders take the category name. With
    ``rich_fallback`` the fallback is cleaned from rich text first.
    """
    key = lambda c: F.when(normalize_key(c) != "", normalize_key(c))
    kept = one_per_key(texts, key(F.col(text_name)), __text=trim(F.col(field)))
    joined = df.join(kept, spread_blanks(df, key(df[name])) == kept["__key"], "left")
    other = rtf_to_html(df[fallback]) if rich_fallback else df[fallback]
    other = F.when(~is_blank(other), trim(other))
    own_name = F.coalesce(trim(df[name]), F.lit(""))
    text = F.when(~is_blank(F.col("__text")), F.col("__text")).otherwise(other)
    return joined.select(*[df[c] for c in df.columns if c != into], fill_placeholder(text, own_name).alias(into))


def rebuild_links(links: DataFrame, articles: DataFrame, attributes: DataFrame, order: Sequence[str]) -> DataFrame:
    """Link rows with ids instead of names; unmatched links go, the first per pair stays.

    Where the order can be written as a minimum, rows are combined within tasks before anything is shuffled.
    """
    from .ordering import first_wins, order_key

    a = one_per_key(articles, F.col("model"), article_id=F.col("id"))
    t = one_per_key(attributes, F.col("name"), attribute_id=F.col("id"))
    extra = [c for c in dict.fromkeys(o.split()[0] for o in order) if c not in ("value", "status")]
    rows = (
        links.join(a.withColumnRenamed("__key", "__model"), links["article"] == F.col("__model"))
        .join(t.withColumnRenamed("__key", "__name"), links["attribute"] == F.col("__name"))
        .select("article_id", "attribute_id", links["status"], links["value"], *[links[c] for c in extra])
    )
    number = F.regexp_extract(F.col("status").cast("string"), r"^\s*([+-]?\d+)", 1).try_cast("bigint")
    status = F.when(F.col("status").isNull(), F.lit(1).cast("bigint")).otherwise(F.coalesce(number, F.lit(0)))
    pair = ["article_id", "attribute_id"]
    key = order_key(rows, order)
    if key:
        first = F.min(F.struct(*[c.alias(f"__o{i}") for i, c in enumerate(key)], "status", "value")).alias("first")
        rows = rows.groupBy(*pair).agg(first).select(*pair, "first.status", "first.value")
    else:
        rows = first_wins(rows, pair, order)
    return rows.select(*pair, status.alias("status"), "value")

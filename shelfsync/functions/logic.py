"""Conditional functions: defaults, case maps, master flags, media rules, guards."""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import Column, functions as F

from .numbers import to_int
from .text import forward_slashes, is_blank, null_if_empty, trim

# The word marking a master article, path segments that name the owner of a file.
MASTER_WORD = "master"
ARTICLE_SEGMENT = "artikel"
CATEGORY_SEGMENT = "warengruppen"

# Media kinds.
TYPE_NONE, TYPE_ARTICLE, TYPE_CATEGORY = 0, 1, 2

# Severity of log levels; an unknown level counts as info.
LEVELS = {"info": 1, "warning": 2, "error": 3}


def coalesce(*cols: Column) -> Column:
    """First value that is neither null nor blank, as it is."""
    return F.coalesce(*[null_if_empty(c) for c in cols])


def default(c: Column, fallback: Column | Any) -> Column:
    """The value, or the fallback (a literal or another expression) when it is blank."""
    other = fallback if isinstance(fallback, Column) else F.lit(fallback)
    return F.when(is_blank(c), other).otherwise(c)


_NO_ELSE = object()


def case(c: Column, branches: dict[Any, Any], else_: Any = _NO_ELSE) -> Column:
    """First branch whose key equals the value as text; without else the value stays.

    ``None`` as key matches null; ``True``/``False`` match by truth of the text.
    """
    text = c.cast("string")
    truth = F.coalesce(text.isin("1", "true"), F.lit(False))

    def hit(key: Any) -> Column:
        if isinstance(key, bool):
            return truth if key else ~truth
        if key is None:
            return text.isNull() | (text == "null")
        return text == str(key)

    pairs = list(branches.items())
    own = text if any(isinstance(v, str) for v in branches.values()) else c
    rest = own if else_ is _NO_ELSE else F.lit(else_)
    if not pairs:
        return rest
    chain = F.when(hit(pairs[0][0]), F.lit(pairs[0][1]))
    return reduce(lambda w, p: w.when(hit(p[0]), F.lit(p[1])), pairs[1:], chain).otherwise(rest)


def _is_master(c: Column) -> Column:
    return F.lower(trim(c)) == MASTER_WORD


def article_master_flag(c: Column) -> Column:
    return F.when(~is_blank(c), _is_master(c).cast("int"))


def article_master_number(c: Column) -> Column:
    return F.when(~is_blank(c) & ~_is_master(c), trim(c))


def master_first(c: Column) -> Column:
    """Sort rank: articles without a master, and masters, come before their variants."""
    return F.when(is_blank(c) | _is_master(c), 0).otherwise(1)


def media_owner(path: Column) -> Column:
    """Struct (type, article, category) read from the folders of a media path.

    A segment named after articles is followed by the article number and ends the search;
    one named after categories is followed by the category, the last one before that counts.
    """
    clean = F.trim(F.regexp_replace(forward_slashes(path), "/+", "/"), F.lit("/"))
    segments = F.split(F.coalesce(clean, F.lit("")), "/")
    followed = F.transform(
        segments,
        lambda s, i: F.struct(
            F.lower(s).alias("name"), trim(F.get(segments, i + 1)).alias("next"), i.alias("at")
        ),
    )
    named = F.filter(
        followed,
        lambda x: x["name"].isin(ARTICLE_SEGMENT, CATEGORY_SEGMENT) & (F.coalesce(x["next"], F.lit("")) != ""),
    )
    article = F.get(F.filter(named, lambda x: x["name"] == ARTICLE_SEGMENT), F.lit(0))
    before = F.filter(
        named,
        lambda x: (x["name"] == CATEGORY_SEGMENT)
        & (article.isNull() | (x["at"] < article["at"])),
    )
    category = F.try_element_at(before, F.lit(-1))
    kind = (
        F.when(article.isNotNull(), TYPE_ARTICLE)
        .when(category.isNotNull(), TYPE_CATEGORY)
        .otherwise(TYPE_NONE)
    )
    return F.struct(
        kind.alias("type"), article["next"].alias("article"), category["next"].alias("category")
    )


def media_detect_type(path: Column) -> Column:
    return media_owner(path)["type"]


def media_extract_article(path: Column) -> Column:
    return media_owner(path)["article"]


def media_extract_category(path: Column) -> Column:
    return media_owner(path)["category"]


def _media_relation(kind: Column, article: Column, category: Column, of_article: Column, of_category: Column) -> Column:
    number = to_int(kind)
    has_article, has_category = ~is_blank(article), ~is_blank(category)
    wants_article = F.coalesce(number != TYPE_CATEGORY, F.lit(True))
    wants_category = F.coalesce(number != TYPE_ARTICLE, F.lit(True))
    return F.when(wants_article & has_article, of_article).when(wants_category & has_category, of_category)


def media_entity_type(kind: Column, article: Column, category: Column) -> Column:
    """Which record a file belongs to; an explicit type admits only its own id."""
    return _media_relation(kind, article, category, F.lit("article"), F.lit("category"))


def media_entity_id(kind: Column, article: Column, category: Column) -> Column:
    return _media_relation(
        kind, article, category, trim(article.cast("string")), trim(category.cast("string"))
    )


def _is_image(mime: Column) -> Column:
    return F.lower(trim(mime)).startswith("image/")


def image_guard(mime: Column, c: Column) -> Column:
    return F.when(is_blank(mime) | _is_image(mime), c)


def document_guard(mime: Column, c: Column) -> Column:
    return F.when(is_blank(mime) | ~_is_image(mime), c)


def level_rank(level: Column) -> Column:
    rank = F.lit(LEVELS["info"])
    for name, value in LEVELS.items():
        rank = F.when(F.lower(level) == name, value).otherwise(rank)
    return rank


def level_at_least(level: Column, minimum: str) -> Column:
    return level_rank(level) >= LEVELS.get(minimum.lower(), LEVELS["info"])


def encode_context(m: Column) -> Column:
    """Map to JSON text; an empty map is stored as null."""
    return F.when(F.size(m) > 0, F.to_json(m))


def decode_context(c: Column) -> Column:
    """Struct (fields, text): parsed JSON object, or the text itself when it is not JSON."""
    fields = F.from_json(c, "map<string,string>")
    return F.struct(
        fields.alias("fields"), F.when(~is_blank(c) & fields.isNull(), c).alias("text")
    )

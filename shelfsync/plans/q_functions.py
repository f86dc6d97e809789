"""Queries for the column functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import compare, logic, numbers, paths, registry, rtf, text
from ..sources.tables import iso_dates as iso_table
from . import catalog as cat
from .base import query, sql_iso, sql_number, sql_slug, sql_trim, table

_BASE = r"regexp_extract(replace({0}, '\', '/'), '([^/]*)/*$', 1)"


@query("fn_text", f"""
WITH m AS ({cat.MEDIA}),
r AS (SELECT media_id, chr(9) || path || chr(10) || ' ' AS raw, path || '//' AS dir, source, quality,
             CASE WHEN lang = 'en' THEN chr(9) || ' ' ELSE ' ' || path END AS maybe FROM m)
SELECT media_id, {sql_trim('raw')} AS trimmed, {_BASE.format('dir')} AS base,
       {_BASE.format(sql_trim('raw'))} AS title,
       CASE WHEN {sql_trim('maybe')} <> '' THEN maybe END AS filled,
       source || coalesce(CAST(quality AS VARCHAR), '') || '-x' AS joined
FROM r""")
def fn_text(spark, d):
    path = F.col("path")
    raw = F.concat(F.lit("\t"), path, F.lit("\n "))
    maybe = F.when(F.col("lang") == "en", F.lit("\t ")).otherwise(F.concat(F.lit(" "), path))
    return cat.media(spark, d).select(
        "media_id",
        text.trim(raw).alias("trimmed"),
        text.basename(F.concat(path, F.lit("//"))).alias("base"),
        text.normalize_title(raw).alias("title"),
        text.null_if_empty(maybe).alias("filled"),
        text.concat(F.col("source"), F.col("quality"), F.lit("-x")).alias("joined"),
    )


@query("fn_slug", f"""
SELECT doc_id, md5({sql_slug("text || ' & ' || lang")}) AS slug,
       md5({sql_slug("text || ' & ' || lang", words=False, accents=False)}) AS plain_slug,
       md5({sql_slug("text || ' & ' || lang", sep='_', words=False, accents=False)}) AS meta_key,
       'smorrebrod-lodz-oeuvre-thing-istanbul-viet-nam-' || doc_id AS rare_letters
FROM documents""")
def fn_slug(spark, d):
    value = F.concat("text", F.lit(" & "), "lang")
    return table(spark, d, "documents").select(
        "doc_id",
        F.md5(text.slugify(value)).alias("slug"),
        F.md5(text.slugify(value, translit=False)).alias("plain_slug"),
        F.md5(text.normalize_key(value)).alias("meta_key"),
        text.slugify(F.concat(F.lit("Smørrebrød łódź Œuvre Þing ıstanbul Vie\u0323\u0302t Nạm "), F.col("doc_id").cast("string"))).alias("rare_letters"),
    )


# Dirty numbers by size of the part; all other parts carry their price.
_DIRTY = {1: "abc", 2: "1.234,56", 3: " 12 ", 4: ".5", 5: "5.", 6: "1e3", 7: "NaN", 8: "1d", 9: "", 10: "-7,25", 11: "Infinity", 12: "+3"}
_WORDS = {1: "ja", 2: "YES ", 3: "true", 4: "1", 5: "1.9", 6: "2", 7: "no", 8: "", 9: "y", 10: "nein"}


def _by_size(values: dict[int, str]):
    c = F.when(F.lit(False), "")
    for size, value in values.items():
        c = c.when(F.col("p_size") == size, value)
    return c


def _sql_by_size(values: dict[int, str], other: str) -> str:
    return "CASE p_size " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in values.items()) + f" ELSE {other} END"


@query("fn_number", f"""
WITH r AS (SELECT p_partkey, {_sql_by_size(_DIRTY, "replace(CAST(p_retailprice AS VARCHAR), '.', ',')")} AS raw,
                  {_sql_by_size(_WORDS, "CAST(p_size AS VARCHAR)")} AS word, p_retailprice FROM part)
SELECT p_partkey, {sql_number("replace(raw, ',', '.')")} AS decimal_value,
       CAST(trunc({sql_number("replace(raw, ',', '.')")}) AS BIGINT) AS whole_of_decimal,
       CAST(trunc({sql_number("raw")}) AS BIGINT) AS whole,
       CAST(CASE WHEN {sql_number("word")} IS NOT NULL THEN CASE WHEN trunc({sql_number("word")}) = 1 THEN 1 ELSE 0 END
                 WHEN lower({sql_trim("word")}) IN ('1', 'true', 'yes', 'ja', 'y') THEN 1 ELSE 0 END AS INTEGER) AS flag,
       CAST(CASE WHEN lower({sql_trim("word")}) IN ('1', 'true', 'yes', 'ja', 'y') THEN 1
                 WHEN lower({sql_trim("word")}) IN ('0', 'false', 'no', 'nein', 'n') THEN 0 END AS INTEGER) AS declared_flag,
       round(p_retailprice + 0.03, 1) AS rounded, 9007199254740993000 + p_partkey AS long_whole
FROM r""")
def fn_number(spark, d):
    price = F.replace(F.col("p_retailprice").cast("string"), F.lit("."), F.lit(","))
    raw = F.coalesce(_by_size(_DIRTY), price)
    word = F.coalesce(_by_size(_WORDS), F.col("p_size").cast("string"))
    return table(spark, d, "part").select(
        "p_partkey",
        numbers.to_decimal(raw).alias("decimal_value"),
        numbers.to_int(numbers.to_decimal(raw)).alias("whole_of_decimal"),
        numbers.to_int(raw).alias("whole"),
        numbers.bool_to_int(word).alias("flag"),
        numbers.convert(word, "boolean").alias("declared_flag"),
        numbers.round_n(F.col("p_retailprice") + 0.03, 1).alias("rounded"),
        numbers.to_int((F.col("p_partkey") + F.lit(9007199254740993000)).cast("string")).alias("long_whole"),
    )


@query("fn_case", """
SELECT p_partkey,
       CASE p_type WHEN 'PROMO' THEN 'sale' WHEN 'LARGE' THEN 'bulk' ELSE p_type END AS kept,
       CASE p_type WHEN 'PROMO' THEN 'sale' ELSE 'other' END AS with_else,
       CAST(CASE WHEN p_size = 1 THEN 7 ELSE 8 END AS INTEGER) AS by_number,
       CASE WHEN p_brand = 'Brand#3' THEN 'none' ELSE p_type END AS by_null,
       CASE WHEN p_size = 1 THEN 'yes' ELSE 'no' END AS by_truth
FROM part""")
def fn_case(spark, d):
    kind, size = F.col("p_type"), F.col("p_size")
    return table(spark, d, "part").select(
        "p_partkey",
        logic.case(kind, {"PROMO": "sale", "LARGE": "bulk"}).alias("kept"),
        logic.case(kind, {"PROMO": "sale"}, "other").alias("with_else"),
        logic.case(size, {1: 7}, 8).alias("by_number"),
        logic.case(F.when(F.col("p_brand") != "Brand#3", kind), {None: "none"}).alias("by_null"),
        logic.case(size, {True: "yes", False: "no"}).alias("by_truth"),
    )


@query("fn_default", f"""
WITH r AS (SELECT doc_id, source, CASE lang WHEN 'de' THEN NULL WHEN 'fr' THEN '   ' WHEN 'es' THEN '' ELSE lang END AS v FROM documents)
SELECT doc_id, CASE WHEN v IS NULL OR {sql_trim('v')} = '' THEN 'a:b' ELSE v END AS literal,
       CASE WHEN v IS NULL OR {sql_trim('v')} = '' THEN source || '/x' ELSE v END AS dynamic,
       CASE WHEN {sql_trim('v')} <> '' THEN v ELSE source END AS first_filled
FROM r""")
def fn_default(spark, d):
    lang = F.col("lang")
    v = F.when(lang == "fr", "   ").when(lang == "es", "").when(lang != "de", lang)
    return table(spark, d, "documents").select(
        "doc_id",
        logic.default(v, "a:b").alias("literal"),
        registry.pipe(v, text.trim, text.null_if_empty, lambda c: logic.default(c, text.concat(F.col("source"), F.lit("/x")))).alias("dynamic"),
        logic.coalesce(v, F.col("source")).alias("first_filled"),
    )


_TAX = {1: "19%", 2: "7.05", 3: "6.95x", 4: "abc", 5: "-0.05", 6: "16.4", 7: "18.95", 8: "5.6", 9: ""}


@query("fn_tax", f"""
WITH r AS (SELECT p_partkey, CASE WHEN p_brand = 'Brand#3' THEN NULL ELSE {_sql_by_size(_TAX, "CASE WHEN p_type = 'PROMO' THEN '7' ELSE '19' END")} END AS raw FROM part),
n AS (SELECT p_partkey, coalesce(TRY_CAST(nullif(regexp_extract(raw, '^\\s*([+-]?\\d+(\\.\\d*)?)', 1), '') AS DOUBLE), 0.0) AS rate FROM r)
SELECT p_partkey, CAST(CASE WHEN abs(rate - 19) < 0.1 THEN 1 WHEN abs(rate - 7) < 0.1 THEN 2 WHEN abs(rate) < 0.1 THEN 0 ELSE round(rate) END AS INTEGER) AS tax_class
FROM n""")
def fn_tax(spark, d):
    plain = F.when(F.col("p_type") == "PROMO", "7").otherwise("19")
    raw = F.when(F.col("p_brand") != "Brand#3", F.coalesce(_by_size(_TAX), plain))
    return table(spark, d, "part").select("p_partkey", numbers.tax_map(raw).alias("tax_class"))


@query("fn_master", f"""
WITH i AS ({cat.INCOMING})
SELECT article_no, CAST(CASE WHEN trim(master) = '' THEN NULL WHEN lower(trim(master)) = 'master' THEN 1 ELSE 0 END AS INTEGER) AS is_master,
       CASE WHEN trim(master) <> '' AND lower(trim(master)) <> 'master' THEN trim(master) END AS master_model
FROM i""")
def fn_master(spark, d):
    return cat.incoming(spark, d).select(
        "article_no",
        logic.article_master_flag(F.col("master")).alias("is_master"),
        logic.article_master_number(F.col("master")).alias("master_model"),
    )


_CLEAN = r"trim(regexp_replace(replace(path, '\', '/'), '/+', '/', 'g'), '/')"


@query("fn_media_path", f"""
WITH m AS ({cat.MEDIA}),
r AS (SELECT media_id, lang, {_CLEAN} AS p FROM m),
x AS (SELECT media_id,
        CASE WHEN lang IN ('de', 'es') THEN regexp_extract(p, '(?i)(?:^|/)artikel/([^/]+)', 1) END AS article,
        CASE WHEN lang IN ('fr', 'es') THEN regexp_extract(p, '(?i)(?:^|/)warengruppen/([^/]+)', 1) END AS category FROM r)
SELECT media_id, CAST(CASE WHEN article IS NOT NULL THEN 1 WHEN category IS NOT NULL THEN 2 ELSE 0 END AS INTEGER) AS media_type, article, category
FROM x""")
def fn_media_path(spark, d):
    path = F.col("path")
    return cat.media(spark, d).select(
        "media_id",
        logic.media_detect_type(path).alias("media_type"),
        logic.media_extract_article(path).alias("article"),
        logic.media_extract_category(path).alias("category"),
    )


@query("fn_media_entity", f"""
WITH m AS ({cat.MEDIA}),
r AS (SELECT media_id, CASE lang WHEN 'de' THEN '1' WHEN 'fr' THEN '2' WHEN 'es' THEN '' END AS k,
             CASE WHEN quality = 1 THEN ' A' || media_id ELSE ' ' END AS a, CASE WHEN toxic IS NOT NULL THEN source END AS c FROM m)
SELECT media_id,
       CASE WHEN coalesce(k, '') <> '2' AND trim(a) <> '' THEN 'article' WHEN coalesce(k, '') <> '1' AND c IS NOT NULL THEN 'category' END AS entity_type,
       CASE WHEN coalesce(k, '') <> '2' AND trim(a) <> '' THEN trim(a) WHEN coalesce(k, '') <> '1' AND c IS NOT NULL THEN c END AS entity_id
FROM r""")
def fn_media_entity(spark, d):
    lang = F.col("lang")
    kind = F.when(lang == "de", "1").when(lang == "fr", "2").when(lang == "es", "")
    article = F.when(F.col("quality") == 1, F.concat(F.lit(" A"), F.col("media_id").cast("string"))).otherwise(" ")
    category = F.when(F.col("toxic").isNotNull(), F.col("source"))
    return cat.media(spark, d).select(
        "media_id",
        logic.media_entity_type(kind, article, category).alias("entity_type"),
        logic.media_entity_id(kind, article, category).alias("entity_id"),
    )


@query("fn_guard", """
WITH r AS (SELECT doc_id, source, CASE lang WHEN 'de' THEN ' IMAGE/png' WHEN 'fr' THEN 'application/pdf' WHEN 'es' THEN ' ' END AS mime FROM documents)
SELECT doc_id, CASE WHEN coalesce(trim(mime), '') = '' OR lower(trim(mime)) LIKE 'image/%' THEN source END AS for_images,
       CASE WHEN coalesce(trim(mime), '') = '' OR lower(trim(mime)) NOT LIKE 'image/%' THEN source END AS for_documents
FROM r""")
def fn_guard(spark, d):
    lang = F.col("lang")
    mime = F.when(lang == "de", " IMAGE/png").when(lang == "fr", "application/pdf").when(lang == "es", " ")
    return table(spark, d, "documents").select(
        "doc_id",
        logic.image_guard(mime, F.col("source")).alias("for_images"),
        logic.document_guard(mime, F.col("source")).alias("for_documents"),
    )


@query("fn_meta_default", f"""
WITH i AS ({cat.INCOMING})
SELECT article_no, trim(title) AS meta_title,
       CASE WHEN trim(title) = '' THEN '' ELSE trim(title) || ' | fast delivery' END AS meta_description,
       CASE WHEN trim(category_code) = '' THEN '' ELSE trim(category_code) || ' | all products' END AS category_title
FROM i""")
def fn_meta_default(spark, d):
    return cat.incoming(spark, d).select(
        "article_no",
        text.meta_default(F.col("title")).alias("meta_title"),
        text.meta_default(F.col("title"), " | fast delivery").alias("meta_description"),
        text.meta_default(F.col("category_code"), " | all products").alias("category_title"),
    )


_EXT = "CASE WHEN contains(name, '.') THEN lower(regexp_extract(name, '([^.]*)$', 1)) ELSE '' END"
_SAFE = "trim(regexp_replace(regexp_replace({0}, '[\\\\/]+', '_', 'g'), '[^A-Za-z0-9._-]+', '_', 'g'), ' ._-')"


@query("fn_mime", f"""
WITH m AS ({cat.MEDIA}), n AS (SELECT media_id, {_BASE.format('path')} AS name FROM m), e AS (SELECT media_id, {_EXT} AS ext FROM n)
SELECT media_id, ext, CASE ext WHEN 'jpg' THEN 'image/jpeg' WHEN 'png' THEN 'image/png' WHEN 'pdf' THEN 'application/pdf'
                               ELSE 'application/octet-stream' END AS mime
FROM e""")
def fn_mime(spark, d):
    extension = paths.ext(text.basename(F.col("path")))
    return cat.media(spark, d).select("media_id", extension.alias("ext"), paths.mime_from_ext(extension).alias("mime"))


@query("fn_vault", f"""
WITH m AS ({cat.MEDIA}),
n AS (SELECT media_id, source, path, {_BASE.format('path')} AS name FROM m),
e AS (SELECT media_id, source, path, name, {_EXT} AS ext FROM n),
v AS (SELECT *, {_SAFE.format("source || '-ä/' || media_id || ' {other}_' || name || ' '")} AS long_name, {_SAFE.format("source")} AS short_name FROM e),
w AS (SELECT *, long_name || CASE WHEN lower(long_name) LIKE '%.' || lower(ext) THEN '' ELSE '.' || ext END AS vault_long,
             short_name || CASE WHEN lower(short_name) LIKE '%.' || lower(ext) THEN '' ELSE '.' || ext END AS vault_short FROM v)
SELECT media_id, vault_long, vault_short, '/vault/' || source || '/' || vault_short AS target, '/vault/' || vault_short AS flat_target,
       CASE WHEN contains(name, '.') THEN regexp_extract(name, '^(.*)\\.[^.]*$', 1) ELSE name END AS stem,
       CASE WHEN starts_with(path, 'srcFiles/') THEN substr(path, 10) ELSE path END AS relative
FROM w""")
def fn_vault(spark, d):
    rows = cat.media(spark, d).withColumn("name", text.basename(F.col("path")))
    extension = paths.ext(F.col("name"))
    known = {"source": F.col("source"), "id": F.col("media_id"), "name": F.col("name")}
    short = paths.vault_name("{source}", known, extension)
    return rows.select(
        "media_id",
        paths.vault_name("{source}-ä/{id} {other}_{name} ", known, extension).alias("vault_long"),
        short.alias("vault_short"),
        paths.vault_path("/vault/", F.concat(F.lit("/"), "source"), short).alias("target"),
        paths.vault_path("/vault", F.lit(" "), short).alias("flat_target"),
        paths.stem(F.col("name")).alias("stem"),
        paths.relative_path(F.col("path"), "srcFiles").alias("relative"),
    )


@query("fn_duration", """
WITH r AS (SELECT l_orderkey, l_linenumber, l_quantity + 0.3 AS short, floor(l_extendedprice / 50) + 0.2 AS middle, l_extendedprice + 0.003 AS long FROM lineitem),
u AS (SELECT l_orderkey, l_linenumber, unnest([short, middle, long]) AS s FROM r)
SELECT l_orderkey, l_linenumber,
       CASE WHEN s < 60 THEN printf('%.1fs', s)
            WHEN s < 3600 THEN printf('%dm %.0fs', CAST(floor(s / 60) AS BIGINT), s - floor(s / 60) * 60)
            ELSE printf('%dh %dm', CAST(floor(s / 3600) AS BIGINT), CAST(floor(s / 60) AS BIGINT) - CAST(floor(s / 3600) AS BIGINT) * 60) END AS duration
FROM u""")
def fn_duration(spark, d):
    values = F.array(F.col("l_quantity") + 0.3, F.floor(F.col("l_extendedprice") / 50) + 0.2, F.col("l_extendedprice") + 0.003)
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.explode(values).alias("s"))
    return rows.select("l_orderkey", "l_linenumber", numbers.format_duration(F.col("s")).alias("duration"))


@query("iso_dates", f"""
SELECT o_orderkey, {sql_iso('o_orderdate')} AS o_orderdate, {sql_iso('o_orderdate')} AS from_seconds FROM orders""")
def iso_dates(spark, d):
    orders = table(spark, d, "orders").select(
        "o_orderkey", "o_orderdate", numbers.iso_time(F.unix_timestamp("o_orderdate")).alias("from_seconds")
    )
    return iso_table(orders)


@query("checksum", """
WITH r AS (SELECT doc_id, '2024-01-02T03:04:05+00:00' || '|' || n_chars AS token FROM documents)
SELECT doc_id, token AS plain, sha256(token) AS hashed, md5(token) AS short_hash, sha1(token) AS sha1_hash FROM r""")
def checksum(spark, d):
    mtime, size = F.lit("2024-01-02T03:04:05+00:00"), F.col("n_chars")
    return table(spark, d, "documents").select(
        "doc_id",
        compare.file_token(mtime, size, "mtime_size").alias("plain"),
        compare.file_token(mtime, size, "sha256").alias("hashed"),
        compare.file_token(mtime, size, "md5").alias("short_hash"),
        compare.file_token(mtime, size, "SHA1").alias("sha1_hash"),
    )


@query("rtf_clean", f"""
WITH a AS (SELECT doc_id, {sql_trim("CASE WHEN lang = 'de' THEN 'Arial, Times-New.Roman;' || text WHEN lang = 'fr' THEN replace(text, chr(10), chr(13) || chr(10) || '  ') ELSE text || '   ' || chr(10) END")} AS t FROM documents),
b AS (SELECT doc_id, regexp_replace(t, '\\r\\n?', chr(10), 'g') AS t FROM a),
c AS (SELECT doc_id, regexp_replace(t, '[ \\t]+\\n', chr(10), 'g') AS t FROM b),
e AS (SELECT doc_id, regexp_replace(t, '[ \\t]+', ' ', 'g') AS t FROM c),
f AS (SELECT doc_id, regexp_replace(t, '^\\s*[\\w\\s\\-,.]+;', '') AS t FROM e)
SELECT doc_id, md5(array_to_string(list_filter(list_transform(string_split(t, chr(10)), lambda x: {sql_trim('x')}), lambda x: x <> ''), '<br>')) AS html,
       CASE doc_id % 3 WHEN 0 THEN 'fein<br>' || doc_id WHEN 1 THEN 'Größe ' || doc_id || '<br>zwei' ELSE doc_id || ' plain' END AS rich
FROM f""")
def rtf_clean(spark, d):
    lang, body = F.col("lang"), F.col("text")
    raw = (
        F.when(lang == "de", F.concat(F.lit("Arial, Times-New.Roman;"), body))
        .when(lang == "fr", F.replace(body, F.lit("\n"), F.lit("\r\n  ")))
        .otherwise(F.concat(body, F.lit("   \n")))
    )
    key = F.col("doc_id").cast("string")
    rich = (
        F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("{\\rtf1 fein\\par "), key, F.lit("}")))
        .when(F.col("doc_id") % 3 == 1, F.concat(F.lit("{\\rtf1\\ansi{\\fonttbl{\\f0 Arial;}}\\f0 Gr\\'f6\\'dfe "), key, F.lit("\\par\\par \\b zwei\\b0}")))
        .otherwise(F.concat(key, F.lit("  plain ")))
    )
    return table(spark, d, "documents").select("doc_id", F.md5(rtf.rtf_to_html(raw)).alias("html"), rtf.rtf_to_html(rich).alias("rich"))


@query("html_strip", r"""
WITH a AS (SELECT page_id, regexp_replace(html, '(?s)<!--.*?-->', '', 'g') AS h FROM pages)
SELECT page_id, regexp_replace(h, '<[^\s"''<>](?:[^"''<>]|"[^"]*"|''[^'']*'')*>', '', 'g') AS plain FROM a""")
def html_strip(spark, d):
    return table(spark, d, "pages").select("page_id", text.remove_html(F.col("html")).alias("plain"))


@query("udf_registry", """
SELECT p_partkey, lower(replace(p_name, ' ', '-')) AS by_name, p_name AS unknown_name,
       CASE WHEN p_type = 'PROMO' THEN p_type ELSE lower(p_type) END AS guarded
FROM part""")
def udf_registry(spark, d):
    names = registry.Registry()

    def shout(value: str) -> str:
        if value == "PROMO":
            raise ValueError(value)
        return value.lower()

    names.register("shout", registry.guarded(shout))
    return table(spark, d, "part").select(
        "p_partkey",
        names.pipe(F.col("p_name"), "trim", "slugify").alias("by_name"),
        names.apply("nowhere", F.col("p_name")).alias("unknown_name"),
        names.apply("shout", F.col("p_type")).alias("guarded"),
    )


@query("udf_errors", """
SELECT 'shout' AS "function", 'ValueError: PROMO' AS message, count(*) AS times, min(p_type) AS example FROM part WHERE p_type = 'PROMO' HAVING count(*) > 0
UNION ALL SELECT 'halve', 'ArithmeticError: odd', count(*), min(CAST(p_size AS VARCHAR)) FROM part WHERE p_size % 2 = 1 HAVING count(*) > 0""")
def udf_errors(spark, d):
    """What registered functions fail on, by function and message."""

    def shout(value: str) -> str:
        if value == "PROMO":
            raise ValueError(value)
        return value.lower()

    def halve(value: str) -> str:
        if int(value) % 2:
            raise ArithmeticError("odd")
        return str(int(value) // 2)

    calls = [(registry.guarded(shout), F.col("p_type")), (registry.guarded(halve), F.col("p_size").cast("string"))]
    return registry.error_log(table(spark, d, "part"), calls)

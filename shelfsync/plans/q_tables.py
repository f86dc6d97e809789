"""Queries for scans, filters, projections, merges, schema and constraint checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import logic, numbers, registry, text
from ..operators import delta, lookups, mapping, merge, ordering, schema
from ..operators.filters import apply_filters, filter_condition
from ..sources.tables import SourceTable, scan_table
from . import catalog as cat
from .base import query, sql_number, sql_trim, table


@query("scan_filter_order", """
SELECT o_orderkey AS number, o_totalprice AS total, o_orderpriority AS priority FROM orders
WHERE o_orderstatus = 'F' AND o_totalprice >= 1000 AND o_orderpriority IS NOT NULL
ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey""")
def scan_filter_order(spark, d):
    spec = SourceTable(
        "orders.parquet",
        {"number": "o_orderkey", "total": "o_totalprice", "priority": "o_orderpriority"},
        {"o_orderstatus": "F", "o_totalprice": {"gte": 1000.0}, "o_orderpriority": {"not_null": True}},
        ["o_orderpriority", "o_totalprice desc", "o_orderkey"],
    )
    return scan_table(spark, spec, d)


_FILTERS = {
    "eq": ({"l_returnflag": "A"}, "l_returnflag = 'A'"),
    "ne": ({"l_returnflag": {"ne": "A"}}, "l_returnflag <> 'A'"),
    "lt": ({"l_quantity": {"lt": 10}}, "l_quantity < 10"),
    "lte": ({"l_quantity": {"le": 10}}, "l_quantity <= 10"),
    "gt": ({"l_quantity": {"gt": 10}}, "l_quantity > 10"),
    "gte": ({"l_quantity": {"gte": 10}}, "l_quantity >= 10"),
    "like": ({"l_linestatus": {"like": "F%"}}, "l_linestatus LIKE 'F%'"),
    "like_any_case": ({"l_linestatus": {"like": "f%"}}, "l_linestatus ILIKE 'f%'"),
    "not_like": ({"l_linestatus": {"not_like": "_"}}, "l_linestatus NOT LIKE '_'"),
    "in": ({"l_linenumber": {"in": [1, 3]}}, "l_linenumber IN (1, 3)"),
    "in_nothing": ({"l_linenumber": {"in": []}}, "false"),
    "not_in": ({"l_linenumber": {"not_in": [1, 3]}}, "l_linenumber NOT IN (1, 3)"),
    "not_in_nothing": ({"l_linenumber": {"not_in": []}}, "true"),
    "between": ({"l_discount": {"between": [0.02, 0.05]}}, "l_discount BETWEEN 0.02 AND 0.05"),
    "not_null": ({"l_tax": {"not_null": False}}, "l_tax IS NOT NULL"),
    "is_null": ({"l_tax": {"is_null": True}}, "l_tax IS NULL"),
}


@query("filter_ops", " UNION ALL ".join(
    f"SELECT '{n}' AS filter, CAST(count(*) AS BIGINT) AS rows FROM lineitem WHERE {sql}" for n, (_, sql) in _FILTERS.items()
))
def filter_ops(spark, d):
    rows = table(spark, d, "lineitem")
    counts = rows.agg(
        *[F.count_if(filter_condition(rule, ignore_case=n == "like_any_case")).alias(n) for n, (rule, _) in _FILTERS.items()]
    )
    return counts.unpivot([], list(_FILTERS), "filter", "rows")


@query("filter_combined", """
SELECT l_orderkey, l_partkey, l_quantity FROM lineitem
WHERE l_quantity >= 5 AND l_quantity < 40 AND l_quantity <> 7 AND l_returnflag IN ('A', 'R') AND l_linestatus = 'F'
  AND l_shipdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1999-12-31'""")
def filter_combined(spark, d):
    rules = {
        "l_quantity": {"gte": 5, "lt": 40, "ne": 7},
        "l_returnflag": {"in": ["A", "R"]},
        "l_linestatus": "F",
        "l_shipdate": {"between": ["1996-01-01", "1999-12-31"]},
    }
    return apply_filters(table(spark, d, "lineitem"), rules).select("l_orderkey", "l_partkey", "l_quantity")


@query("map_article", f"""
WITH i AS ({cat.INCOMING})
SELECT article_no AS model, trim(title) AS name, round({sql_number("replace(price_text, ',', '.')")}, 2) AS price,
       CAST(trunc({sql_number("stock_text")}) AS BIGINT) AS stock, CAST(CASE WHEN online = 'ja' THEN 1 ELSE 0 END AS INTEGER) AS status,
       nullif(trim(category_code), '') AS category, 'de' AS language, CAST(0 AS INTEGER) AS change, brand AS attribute
FROM i""")
def map_article(spark, d):
    c = F.col
    tables = mapping.map_columns(
        cat.incoming(spark, d),
        {
            "shop.article.model": registry.pipe(c("article_no"), text.trim),
            "shop.article.name": registry.pipe(c("title"), text.trim, text.null_if_empty),
            "shop.article.price": registry.pipe(c("price_text"), numbers.to_decimal, lambda v: numbers.round_n(v, 2)),
            "shop.article.stock": numbers.to_int(c("stock_text")),
            "shop.article.status": numbers.bool_to_int(c("online")),
            "shop.article.category": registry.pipe(c("category_code"), text.trim, text.null_if_empty),
            "shop.article.language": "de",
            "shop.article.change": 0,
            "shop.attribute.model": text.trim(c("article_no")),
            "shop.attribute.attribute": c("brand"),
        },
    )
    return tables["article"].join(tables["attribute"], "model")


@query("require_keys", """
WITH r AS (SELECT d.doc_id, CASE WHEN toxic = 1 THEN ' ' ELSE CAST(quality AS VARCHAR) END AS grade FROM documents d LEFT JOIN labels l USING (doc_id))
SELECT 'kept' AS fate, doc_id, grade FROM r WHERE trim(grade) <> ''
UNION ALL SELECT 'skipped', doc_id, grade FROM r WHERE grade IS NULL OR trim(grade) = ''""")
def require_keys(spark, d):
    rows = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left").select(
        "doc_id", F.when(F.col("toxic") == 1, " ").otherwise(F.col("quality").cast("string")).alias("grade")
    )
    kept = mapping.require_keys(rows, ["doc_id", "grade"]).select(F.lit("kept").alias("fate"), "*")
    return kept.unionByName(mapping.without_keys(rows, ["doc_id", "grade"]).select(F.lit("skipped").alias("fate"), "*"))


@query("media_name_fallback", """
WITH r AS (SELECT doc_id, CASE lang WHEN 'de' THEN ' ' WHEN 'fr' THEN NULL ELSE source END AS file_name,
                  CASE WHEN n_chars > 1000 THEN md5(text) ELSE '' END AS hash FROM documents)
SELECT doc_id, CASE WHEN trim(coalesce(file_name, '')) <> '' THEN file_name ELSE hash END AS file_name, hash
FROM r WHERE trim(coalesce(file_name, '')) <> '' OR hash <> ''""")
def media_name_fallback(spark, d):
    lang = F.col("lang")
    rows = table(spark, d, "documents").select(
        "doc_id",
        F.when(lang == "de", " ").when(lang != "fr", F.col("source")).alias("file_name"),
        F.when(F.col("n_chars") > 1000, F.md5("text")).otherwise("").alias("hash"),
    )
    return mapping.fill_file_name(rows)


_OLD_LINES = """SELECT l_orderkey AS order_no, l_partkey AS part_no, max(l_quantity) AS quantity, min(l_extendedprice) AS price,
       max(l_returnflag) AS note, 'stored' AS origin FROM lineitem WHERE l_linestatus = 'F' GROUP BY ALL"""
_NEW_LINES = """SELECT l_orderkey AS order_no, l_partkey AS part_no, max(l_extendedprice) AS price,
       CASE WHEN max(l_tax) > 0.04 THEN max(l_linestatus) END AS note FROM lineitem WHERE l_returnflag <> 'N' GROUP BY l_orderkey, l_partkey"""


def _old_lines(spark, d):
    keys = [F.col("l_orderkey").alias("order_no"), F.col("l_partkey").alias("part_no")]
    return table(spark, d, "lineitem").where("l_linestatus = 'F'").groupBy(*keys).agg(
        F.max("l_quantity").alias("quantity"), F.min("l_extendedprice").alias("price"),
        F.max("l_returnflag").alias("note"), F.lit("stored").alias("origin"),
    )


def _new_lines(spark, d):
    keys = [F.col("l_orderkey").alias("order_no"), F.col("l_partkey").alias("part_no")]
    return table(spark, d, "lineitem").where("l_returnflag <> 'N'").groupBy(*keys).agg(
        F.max("l_extendedprice").alias("price"), F.when(F.max("l_tax") > 0.04, F.max("l_linestatus")).alias("note")
    )


_UPSERT_SQL = f"""
WITH o AS ({_OLD_LINES}), n AS ({_NEW_LINES})
SELECT coalesce(o.order_no, n.order_no) AS order_no, coalesce(o.part_no, n.part_no) AS part_no, o.quantity,
       CASE WHEN n.order_no IS NOT NULL THEN n.price ELSE o.price END AS price,
       CASE WHEN n.order_no IS NOT NULL THEN n.note ELSE o.note END AS note, o.origin
FROM o FULL JOIN n ON o.order_no = n.order_no AND o.part_no = n.part_no"""


@query("upsert_partial", _UPSERT_SQL)
def upsert_partial(spark, d):
    return merge.upsert(_old_lines(spark, d), _new_lines(spark, d), ["order_no", "part_no"])


@query("upsert_small", _UPSERT_SQL)
def upsert_small(spark, d):
    return merge.upsert(_old_lines(spark, d), _new_lines(spark, d), ["order_no", "part_no"], small_changes=True)


@query("replace_merge", f"""
WITH s AS ({cat.STORED}),
n AS (SELECT 'P' || p_partkey AS model, p_name AS name, p_retailprice AS price FROM part WHERE p_size > 20)
SELECT s.id, s.model, s.name, s.price, s.status FROM s WHERE s.model NOT IN (SELECT model FROM n)
UNION ALL
SELECT (SELECT max(id) FROM s) + row_number() OVER (ORDER BY model), model, name, price, NULL FROM n""")
def replace_merge(spark, d):
    target = cat.stored(spark, d).select("id", "model", "name", "price", "status")
    staged = table(spark, d, "part").where("p_size > 20").select(
        F.concat(F.lit("P"), "p_partkey").alias("model"), F.col("p_name").alias("name"), F.col("p_retailprice").alias("price")
    )
    top = target.agg(F.max("id")).first()[0]
    return merge.replace_merge(target, staged, ["model"], ["model"], "id", top)


@query("insert_ignore", """
WITH t AS (SELECT l_partkey AS part_no, l_suppkey AS supplier_no, CAST(min(l_quantity) AS DOUBLE) AS quantity, 'stored' AS origin FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2),
n AS (SELECT l_partkey AS part_no, l_suppkey AS supplier_no, max(l_quantity) AS quantity FROM lineitem GROUP BY 1, 2)
SELECT * FROM t UNION ALL
SELECT part_no, supplier_no, quantity, 'new' FROM n WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.part_no = n.part_no AND t.supplier_no = n.supplier_no)""")
def insert_ignore(spark, d):
    keys = [F.col("l_partkey").alias("part_no"), F.col("l_suppkey").alias("supplier_no")]
    lines = table(spark, d, "lineitem")
    target = lines.where("l_returnflag = 'R'").groupBy(*keys).agg(F.min("l_quantity").alias("quantity"), F.lit("stored").alias("origin"))
    rows = lines.select(*keys, F.col("l_quantity").alias("quantity"), F.lit("new").alias("origin"))
    return merge.insert_ignore(target, rows, ["part_no", "supplier_no"], ["quantity desc"])


@query("delete_by_key", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'A')""")
def delete_by_key(spark, d):
    gone = table(spark, d, "lineitem").where("l_returnflag = 'A'").select(F.col("l_orderkey").alias("o_orderkey"))
    return merge.delete_by_key(table(spark, d, "orders"), gone, ["o_orderkey"]).select("o_orderkey", "o_totalprice")


_PART_TABLE = schema.TargetTable(
    "part",
    {
        "p_partkey": schema.Field("integer"),
        "p_name": schema.Field("text"),
        "p_retailprice": schema.Field("real"),
        "change": schema.Field("integer", default=0),
        "status": schema.Field("integer", default=1),
        "note": schema.Field("text", default="none"),
        "online": schema.Field("bool"),
    },
    business_key=["p_partkey"],
)


@query("create_schema", """
SELECT CAST(p_partkey AS BIGINT) AS p_partkey, p_name, CAST(p_retailprice AS DOUBLE) AS p_retailprice, CAST(NULL AS BIGINT) AS change,
       CAST(NULL AS BIGINT) AS status, CAST(NULL AS VARCHAR) AS note, CAST(NULL AS INTEGER) AS online FROM part""")
def create_schema(spark, d):
    rows = table(spark, d, "part").select("p_partkey", "p_name", "p_retailprice")
    return merge.append(schema.create_table(spark, _PART_TABLE), rows)


@query("schema_evolve", """
SELECT p_partkey, p_name, p_retailprice, CAST(CASE WHEN p_size > 40 THEN 0 ELSE 1 END AS INTEGER) AS change,
       CAST(1 AS BIGINT) AS status, 'none' AS note, CAST(0 AS INTEGER) AS online FROM part""")
def schema_evolve(spark, d):
    rows = table(spark, d, "part").select(
        "p_partkey", "p_name", "p_retailprice", F.when(F.col("p_size") <= 40, 1).alias("change")
    )
    return schema.add_missing_columns(rows, _PART_TABLE, flags=["change", "online"])


@query("unique_violations", """
SELECT 'all' AS rule, l_orderkey, l_linenumber, CAST(count(*) AS BIGINT) AS rows FROM lineitem GROUP BY 2, 3 HAVING count(*) > 1
UNION ALL
SELECT 'returned', l_orderkey, l_linenumber, CAST(count(*) AS BIGINT) FROM lineitem WHERE l_returnflag = 'R' GROUP BY 2, 3 HAVING count(*) > 1""")
def unique_violations(spark, d):
    lines, keys = table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"]
    every = schema.check_unique(lines, keys).select(F.lit("all").alias("rule"), "*")
    some = schema.check_unique(lines, keys, F.col("l_returnflag") == "R").select(F.lit("returned").alias("rule"), "*")
    return every.unionByName(some)


@query("check_violations", """
SELECT 'status_flag' AS "constraint", CAST(count(*) AS BIGINT) AS violations FROM lineitem WHERE l_linestatus NOT IN ('F')
UNION ALL SELECT 'first_lines', CAST(count(*) AS BIGINT) FROM lineitem WHERE l_linenumber NOT IN (0, 1)
UNION ALL SELECT 'has_price', CAST(count(*) AS BIGINT) FROM lineitem WHERE l_extendedprice IS NULL
UNION ALL SELECT 'low_discount', CAST(count(*) AS BIGINT) FROM lineitem WHERE NOT (l_discount <= 0.05)""")
def check_violations(spark, d):
    return schema.check_constraints(
        table(spark, d, "lineitem"),
        {
            "status_flag": schema.one_of("l_linestatus", "F"),
            "first_lines": schema.one_of("l_linenumber", 0, 1),
            "has_price": schema.required("l_extendedprice"),
            "low_discount": F.col("l_discount") <= 0.05,
        },
    )


@query("fk_violations", """
SELECT 'label' AS rule, doc_id AS child FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
UNION ALL SELECT 'supplier', l_orderkey FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)""")
def fk_violations(spark, d):
    unlabelled = schema.fk_violations(table(spark, d, "documents"), "doc_id", table(spark, d, "labels"), "doc_id")
    solvent = table(spark, d, "supplier").where("s_acctbal > 0")
    homeless = schema.fk_violations(table(spark, d, "lineitem"), "l_suppkey", solvent, "s_suppkey")
    return unlabelled.select(F.lit("label").alias("rule"), F.col("doc_id").alias("child")).unionByName(
        homeless.select(F.lit("supplier").alias("rule"), F.col("l_orderkey").alias("child"))
    )


@query("table_counts", " UNION ALL ".join(
    f"SELECT '{n}' AS \"table\", CAST(count(*) AS BIGINT) AS rows FROM {n}" for n in ("part", "lineitem", "orders", "documents", "events")
))
def table_counts(spark, d):
    return schema.table_counts({n: table(spark, d, n) for n in ("part", "lineitem", "orders", "documents", "events")})


# The columns of the given tables.
_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def _introspect_sql() -> str:
    parts = []
    for name, columns in _SCHEMAS.items():
        for i, column in enumerate(columns.split(", "), 1):
            field, kind = column.split()
            default = _PART_TABLE.definitions()[field].default if name == "part" and field in _PART_TABLE.definitions() else None
            key = name == "part" and field in _PART_TABLE.merge_keys()
            shown = "CAST(NULL AS VARCHAR)" if default is None else f"'{default}'"
            parts.append(
                f"SELECT '{name}' AS \"table\", CAST({i} AS INTEGER) AS position, '{field}' AS name, '{kind}' AS type, true AS nullable, "
                f"{shown} AS \"default\", {str(key).lower()} AS key, (SELECT count(*) FROM {name}) AS rows"
            )
    return " UNION ALL ".join(parts)


@query("introspect", _introspect_sql())
def introspect(spark, d):
    """Columns of every table, with its number of rows."""
    tables = {n: table(spark, d, n) for n in _SCHEMAS}
    columns = schema.introspect({n: (df, _PART_TABLE if n == "part" else None) for n, df in tables.items()})
    return columns.join(schema.table_counts(tables), "table")


@query("distinct_attributes", """
SELECT DISTINCT p_brand || '/' || p_type AS name FROM part WHERE p_type <> 'SMALL'""")
def distinct_attributes(spark, d):
    kind = F.when(F.col("p_type") == "SMALL", F.lit(" ")).otherwise(F.concat("p_brand", F.lit("/"), "p_type"))
    return table(spark, d, "part").select(kind.alias("name")).where(~text.is_blank(F.col("name"))).distinct()


@query("page_rownum", """
SELECT row_no, l_orderkey, l_linenumber, l_partkey FROM (
  SELECT row_number() OVER (ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey) AS row_no, * FROM lineitem) WHERE row_no BETWEEN 101 AND 150""")
def page_rownum(spark, d):
    order = ["l_extendedprice desc", "l_orderkey", "l_linenumber", "l_partkey"]
    rows = table(spark, d, "lineitem").select(*[o.split()[0] for o in order])
    return ordering.page_by_row_number(rows, order, 100, 50).select("row_no", "l_orderkey", "l_linenumber", "l_partkey")


@query("page_offset", """
SELECT 'third' AS page, o_orderkey, o_totalprice FROM (SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50 OFFSET 100)
UNION ALL
SELECT 'last', o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS n, count(*) OVER () AS total FROM orders)
WHERE n > ((total - 1) // 70) * 70""")
def page_offset(spark, d):
    orders, order = table(spark, d, "orders").select("o_orderkey", "o_totalprice"), ["o_totalprice desc", "o_orderkey"]
    third = ordering.page(orders, order, 3, 50).select(F.lit("third").alias("page"), "*")
    return third.unionByName(ordering.page(orders, order, 10**9, 70).select(F.lit("last").alias("page"), "*"))


@query("natural_sort", """
SELECT name, CAST(row_number() OVER (ORDER BY lower(regexp_extract(name, '^([^0-9]*)', 1)), CAST(regexp_extract(name, '([0-9]+)$', 1) AS BIGINT), name) AS BIGINT) AS position
FROM (SELECT CASE WHEN s_acctbal > 5000 THEN 'supplier' ELSE 'Supplier' END || s_suppkey AS name FROM supplier
      UNION ALL SELECT 'Nation_' || n_nationkey FROM nation UNION ALL SELECT 'customer ' || c_custkey FROM customer)""")
def natural_sort(spark, d):
    suppliers = table(spark, d, "supplier").select(
        F.concat(F.when(F.col("s_acctbal") > 5000, "supplier").otherwise("Supplier"), "s_suppkey").alias("name")
    )
    nations = table(spark, d, "nation").select(F.concat(F.lit("Nation_"), "n_nationkey").alias("name"))
    customers = table(spark, d, "customer").select(F.concat(F.lit("customer "), "c_custkey").alias("name"))
    names = suppliers.unionByName(nations).unionByName(customers)
    keyed = names.withColumn("key", ordering.natural_key(F.col("name")))
    return ordering.global_number(keyed, ["key", "name"], "position").select("name", "position")


@query("master_first", f"""
WITH i AS ({cat.INCOMING})
SELECT article_no, CAST(row_number() OVER (ORDER BY CASE WHEN trim(master) = '' OR lower(trim(master)) = 'master' THEN 0 ELSE 1 END, article_no) AS BIGINT) AS position FROM i""")
def master_first(spark, d):
    rows = cat.incoming(spark, d).select("article_no", logic.master_first(F.col("master")).alias("rank"))
    return ordering.global_number(rows, ["rank", "article_no"], "position").drop("rank")


@query("assign_ids", """
SELECT 5000 + row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS id, o_orderkey FROM orders""")
def assign_ids(spark, d):
    rows = table(spark, d, "orders").select("o_orderdate", "o_orderkey")
    return ordering.assign_ids(rows, ["o_orderdate", "o_orderkey"], 5000).select("id", "o_orderkey")


@query("union_first_wins", """
SELECT name, arg_min(origin, rank) AS origin FROM (
  SELECT p_type AS name, 'part' AS origin, 1 AS rank FROM part UNION ALL SELECT DISTINCT o_orderpriority, 'order', 2 FROM orders
  UNION ALL SELECT 'PROMO', 'line', 3 FROM lineitem UNION ALL SELECT l_returnflag, 'line', 3 FROM lineitem) GROUP BY name""")
def union_first_wins(spark, d):
    def names(source, column, origin):
        return table(spark, d, source).select(column.alias("name"), F.lit(origin).alias("origin"))

    frames = [
        names("part", F.col("p_type"), "part"),
        names("orders", F.col("o_orderpriority"), "order"),
        names("lineitem", F.lit("PROMO"), "line").unionByName(names("lineitem", F.col("l_returnflag"), "line")),
    ]
    return merge.union_first_wins(frames, ["name"], ["origin"])


@query("first_wins", """
SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n FROM orders) WHERE n = 1""")
def first_wins(spark, d):
    rows = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return ordering.first_wins(rows, ["o_custkey"], ["o_orderkey"])


@query("fold_duplicates", """
SELECT o_custkey, o_orderkey, o_orderstatus, previous_status,
       CASE WHEN previous_status IS NULL THEN 'insert' WHEN previous_status <> o_orderstatus THEN 'update' ELSE 'unchanged' END AS action
FROM (SELECT *, lag(o_orderstatus) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS previous_status,
             row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS n FROM orders) WHERE n = 1""")
def fold_duplicates(spark, d):
    rows = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    folded = ordering.fold_duplicates(rows, ["o_custkey"], ["o_orderkey"], ["o_orderstatus"])
    before = F.col("previous.o_orderstatus")
    return folded.select(
        "o_custkey", "o_orderkey", "o_orderstatus", before.alias("previous_status"),
        delta.action(F.col("previous").isNotNull(), before != F.col("o_orderstatus")).alias("action"),
    )


_LINKS = """SELECT 'P' || l_partkey AS article, 'S' || l_suppkey AS attribute,
       CASE l_returnflag WHEN 'A' THEN '0' WHEN 'N' THEN 'x' END AS status, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS value FROM lineitem"""


@query("rebuild_links", f"""
WITH l AS ({_LINKS}),
j AS (SELECT p_partkey + 10 AS article_id, s_suppkey + 20 AS attribute_id,
             CAST(CASE WHEN status IS NULL THEN 1 ELSE coalesce(TRY_CAST(status AS BIGINT), 0) END AS BIGINT) AS status, value, status AS raw
      FROM l JOIN part ON article = 'P' || p_partkey JOIN (SELECT * FROM supplier WHERE s_acctbal > 0) ON attribute = 'S' || s_suppkey)
SELECT article_id, attribute_id, status, value
FROM (SELECT *, row_number() OVER (PARTITION BY article_id, attribute_id ORDER BY CAST(value AS BIGINT) DESC, raw NULLS FIRST) AS n FROM j) WHERE n = 1""")
def rebuild_links(spark, d):
    flag = F.col("l_returnflag")
    links = table(spark, d, "lineitem").select(
        F.concat(F.lit("P"), "l_partkey").alias("article"),
        F.concat(F.lit("S"), "l_suppkey").alias("attribute"),
        F.when(flag == "A", "0").when(flag == "N", "x").alias("status"),
        F.col("l_quantity").cast("bigint").cast("string").alias("value"),
        F.col("l_quantity").alias("amount"),
        F.when(flag == "A", "0").when(flag == "N", "x").alias("raw"),
    )
    articles = table(spark, d, "part").select((F.col("p_partkey") + 10).alias("id"), F.concat(F.lit("P"), "p_partkey").alias("model"))
    attributes = table(spark, d, "supplier").where("s_acctbal > 0").select(
        (F.col("s_suppkey") + 20).alias("id"), F.concat(F.lit("S"), "s_suppkey").alias("name")
    )
    return lookups.rebuild_links(links, articles, attributes, ["amount desc", "raw"])


_DIM_CUSTOMER = "SELECT 'C' || c_custkey AS code, c_custkey + 7 AS id FROM customer WHERE c_mktsegment <> 'MACHINERY'"


def _customers(spark, d):
    return table(spark, d, "customer").where("c_mktsegment <> 'MACHINERY'").select(
        F.concat(F.lit("C"), "c_custkey").alias("code"), (F.col("c_custkey") + 7).alias("id")
    )


def _orders_by_text(spark, d):
    code = F.when(F.col("o_orderstatus") == "P", " ").otherwise(F.concat(F.lit(" C"), F.col("o_custkey").cast("string"), F.lit("\t")))
    return table(spark, d, "orders").select("o_orderkey", code.alias("customer"))


_ORDERS_BY_TEXT = "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN ' ' ELSE ' C' || o_custkey || chr(9) END AS customer FROM orders"


@query("fk_default_zero", f"""
WITH o AS ({_ORDERS_BY_TEXT}), k AS ({_DIM_CUSTOMER})
SELECT o_orderkey, coalesce(id, 0) AS customer FROM o LEFT JOIN k ON {sql_trim('customer')} = code""")
def fk_default_zero(spark, d):
    return lookups.resolve_fk(_orders_by_text(spark, d), "customer", _customers(spark, d), "code", on_missing="default")


@query("fk_keep", f"""
WITH o AS ({_ORDERS_BY_TEXT}), k AS ({_DIM_CUSTOMER})
SELECT o_orderkey, coalesce(CAST(id AS VARCHAR), customer) AS customer FROM o LEFT JOIN k ON {sql_trim('customer')} = code""")
def fk_keep(spark, d):
    return lookups.resolve_fk(_orders_by_text(spark, d), "customer", _customers(spark, d), "code", on_missing="keep")


@query("fk_null", f"""
WITH o AS ({_ORDERS_BY_TEXT}), k AS ({_DIM_CUSTOMER})
SELECT o_orderkey, id AS customer FROM o LEFT JOIN k ON {sql_trim('customer')} = code""")
def fk_null(spark, d):
    return lookups.resolve_fk(_orders_by_text(spark, d), "customer", _customers(spark, d), "code")


@query("fk_two_dims", """
SELECT l_orderkey, l_linenumber, p.p_partkey + 1 AS article, CAST(s.s_suppkey + 2 AS BIGINT) AS attribute
FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_type <> 'PROMO') p ON l_partkey = p_partkey
LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 0) s ON l_suppkey = s_suppkey""")
def fk_two_dims(spark, d):
    lines = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.concat(F.lit("P"), "l_partkey").alias("article"), F.concat(F.lit("S"), "l_suppkey").alias("attribute"),
    )
    articles = table(spark, d, "part").where("p_type <> 'PROMO'").select(
        F.concat(F.lit("P"), "p_partkey").alias("model"), (F.col("p_partkey") + 1).alias("id")
    )
    attributes = table(spark, d, "supplier").where("s_acctbal > 0").select(
        F.concat(F.lit("S"), "s_suppkey").alias("name"), (F.col("s_suppkey") + 2).alias("id")
    )
    return lookups.resolve_fk(lookups.resolve_fk(lines, "article", articles, "model"), "attribute", attributes, "name")


@query("image_fanout", """
WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, unnest([
    {'n': 1, 'name': 'p' || l_suppkey % 7 || '.jpg'}, {'n': 2, 'name': CASE WHEN l_quantity > 25 THEN ' ' ELSE 'p' || l_partkey % 7 || '.jpg' END},
    {'n': 3, 'name': CASE WHEN l_tax > 0.04 THEN NULL ELSE 'q' || l_linenumber END}, {'n': 10, 'name': 'p' || l_linenumber || '.jpg'}]) AS e, row_number() OVER () AS id FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(min(e.n) AS INTEGER) AS n, e.name AS name
FROM r WHERE trim(coalesce(e.name, '')) <> '' GROUP BY id, l_orderkey, l_linenumber, l_partkey, l_suppkey, e.name""")
def image_fanout(spark, d):
    suffix, part, supplier = F.lit(".jpg"), F.col("l_partkey") % 7, F.col("l_suppkey") % 7
    images = {f"Bild{i}": F.lit(None).cast("string") for i in range(1, 11)}
    images["Bild1"] = F.concat(F.lit("p"), supplier, suffix)
    images["Bild2"] = F.when(F.col("l_quantity") > 25, " ").otherwise(F.concat(F.lit("p"), part, suffix))
    images["Bild3"] = F.when(F.col("l_tax") <= 0.04, F.concat(F.lit("q"), "l_linenumber"))
    images["Bild10"] = F.concat(F.lit("p"), "l_linenumber", suffix)
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return delta.fan_out(table(spark, d, "lineitem").withColumns(images), keys)

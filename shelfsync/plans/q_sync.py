"""Queries for change capture, slugs, the category tree, and whole entity runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import compare, logic, numbers, registry, text
from ..operators import delta, lookups, merge, run_log, slugs, sync, tree
from ..operators.orphans import OrphanPolicy, orphan_update
from ..operators.schema import table_counts
from ..sources.snapshots import SnapshotStore
from . import catalog as cat
from .base import query, scratch, sql_number, sql_slug, table

NOW = "2024-06-01T00:00:00+00:00"

# The incoming articles as target rows.
_MAPPED = f"""
SELECT article_no AS model, trim(title) AS name, round({sql_number("replace(price_text, ',', '.')")}, 2) AS price,
       CAST(CASE tax_text WHEN '7' THEN 2 WHEN '0' THEN 0 WHEN '16,0' THEN 16 ELSE 1 END AS INTEGER) AS tax_class,
       CAST(CASE WHEN online = 'ja' THEN 1 ELSE 0 END AS INTEGER) AS status FROM i"""


def article_columns() -> dict:
    c = F.col
    return {
        "model": registry.pipe(c("article_no"), text.trim),
        "name": registry.pipe(c("title"), text.trim, text.null_if_empty),
        "price": registry.pipe(c("price_text"), numbers.to_decimal, lambda v: numbers.round_n(v, 2)),
        "tax_class": numbers.tax_map(c("tax_text")),
        "status": numbers.bool_to_int(c("online")),
    }


DELTA = ("name", "price", "tax_class")

ARTICLE = sync.EntitySpec(
    name="article",
    source="articles",
    target="article",
    columns={},
    keys=("model",),
    delta=DELTA,
    on_insert={"change": 1, "updated_at": NOW},
    on_changed={"change": 1, "updated_at": NOW},
    on_unchanged={"change": 0},
    orphans=(OrphanPolicy(("model",), {"status": 0, "change": 1}),),
)


def article_spec(**changes) -> sync.EntitySpec:
    from dataclasses import replace

    return replace(ARTICLE, **{"columns": article_columns(), **changes})


_JOINED = f"""
i AS ({cat.INCOMING}), n AS ({_MAPPED}), o AS ({cat.STORED}),
j AS (SELECT coalesce(n.model, o.model) AS model, n.model IS NOT NULL AS is_new, o.model IS NOT NULL AS is_old,
             n.name AS new_name, o.name AS old_name, n.price AS new_price, o.price AS old_price, n.tax_class AS new_tax, o.tax_class AS old_tax,
             n.status AS new_status, o.status AS old_status, o.change AS old_change, o.updated_at AS old_at,
             (n.name IS DISTINCT FROM o.name OR n.price IS DISTINCT FROM o.price OR n.tax_class IS DISTINCT FROM o.tax_class) AS differs
      FROM n FULL JOIN o ON n.model = o.model),
s AS (SELECT *, CASE WHEN is_new AND NOT is_old THEN 'insert' WHEN is_new AND differs THEN 'update' WHEN is_new THEN 'unchanged'
                     WHEN old_status <> 0 OR old_change <> 1 THEN 'orphan' ELSE 'kept' END AS action FROM j)"""

_SYNC_SQL = f"""
WITH {_JOINED}
SELECT model, CASE WHEN is_new THEN new_name ELSE old_name END AS name, CASE WHEN is_new THEN new_price ELSE old_price END AS price,
       CASE WHEN is_new THEN new_tax ELSE old_tax END AS tax_class,
       CAST(CASE WHEN is_new THEN new_status WHEN action = 'orphan' THEN 0 ELSE old_status END AS INTEGER) AS status,
       CAST(CASE action WHEN 'unchanged' THEN 0 WHEN 'kept' THEN old_change ELSE 1 END AS INTEGER) AS change, action
FROM s"""


def _classified(spark, d, spec=None):
    target = cat.stored(spark, d).select("model", "name", "price", "tax_class", "status", "change", "updated_at")
    return sync.classify_entity(spec or article_spec(), cat.incoming(spark, d), target)


@query("sync_entity", _SYNC_SQL)
def sync_entity(spark, d):
    return _classified(spark, d).drop("updated_at")


@query("sync_stats", f"""
WITH {_JOINED}
SELECT CAST(count(*) FILTER (action = 'insert') AS BIGINT) AS inserted, CAST(count(*) FILTER (action = 'update') AS BIGINT) AS updated,
       CAST(count(*) FILTER (action = 'unchanged') AS BIGINT) AS unchanged, CAST(count(*) FILTER (action = 'orphan') AS BIGINT) AS orphans,
       CAST(count(*) FILTER (is_new) AS BIGINT) AS total, CAST(0 AS BIGINT) AS deleted FROM s""")
def sync_stats(spark, d):
    counts = sync.sync_stats(_classified(spark, d)).drop("unchanged")
    total = sync.intake_stats(article_spec(), cat.incoming(spark, d)).select((F.col("processed") - F.col("skipped")).alias("total"))
    tagged = counts.withColumn("__one", F.lit(1)).join(total.withColumn("__one", F.lit(1)), "__one").drop("__one")
    return run_log.record_changes(tagged.withColumn("deleted", F.lit(0).cast("bigint")))


@query("delta_classify", f"WITH {_JOINED} SELECT model, new_price AS price, action FROM s WHERE is_new")
def delta_classify(spark, d):
    rows = cat.incoming(spark, d).select(*[c.alias(n) for n, c in article_columns().items()])
    return delta.delta_classify(rows, cat.stored(spark, d), ["model"], DELTA).select("model", "price", "action")


@query("flags", f"""
WITH {_JOINED}
SELECT model, action, CAST(CASE action WHEN 'unchanged' THEN 0 ELSE 1 END AS INTEGER) AS change,
       CASE action WHEN 'unchanged' THEN 'before' ELSE '{NOW}' END AS updated_at,
       CASE action WHEN 'insert' THEN model || '/' || '{NOW}' END AS stamp FROM s WHERE is_new""")
def flags(spark, d):
    rows = delta_classify(spark, d).drop("price").withColumn("updated_at", F.lit("before"))
    return delta.apply_flags(
        rows,
        on_insert={"change": 1, "updated_at": NOW, "stamp": lambda row: F.concat_ws("/", F.col("model"), row["updated_at"])},
        on_changed={"change": 1, "updated_at": NOW},
        on_unchanged={"change": 0},
    )


def _customers_of_large_orders(spark, d):
    """All orders; the customers of small or open ones have keys that no table knows."""
    large = (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 250000)
    return table(spark, d, "orders").withColumn("id", F.when(large, F.col("o_custkey")).otherwise(F.col("o_custkey") + 100000000))


@query("orphans", """
WITH o AS (SELECT c_custkey AS id, c_mktsegment AS segment, CAST(CASE WHEN c_acctbal > 5000 THEN 1 ELSE 0 END AS INTEGER) AS status FROM customer),
s AS (SELECT DISTINCT CASE WHEN o_orderstatus = 'F' AND o_totalprice > 250000 THEN o_custkey ELSE o_custkey + 100000000 END AS o_custkey FROM orders)
SELECT id, segment, CAST(CASE WHEN gone THEN 0 ELSE status END AS INTEGER) AS status, gone AS orphaned
FROM (SELECT *, status <> 0 AND segment <> 'MACHINERY' AND id NOT IN (SELECT o_custkey FROM s) AS gone FROM o)""")
def orphans(spark, d):
    target = table(spark, d, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"),
        F.when(F.col("c_acctbal") > 5000, 1).otherwise(0).alias("status"),
    )
    seen = _customers_of_large_orders(spark, d).select("id")
    policy = OrphanPolicy(("id",), {"status": 0}, scope=F.col("segment") != "MACHINERY")
    return orphan_update(target, seen, [policy])


@query("row_hash_delta", """
WITH r AS (SELECT l_orderkey, l_linenumber, sha256(l_orderkey || chr(31) || l_linenumber || chr(31) || coalesce(l_returnflag, '')) AS seen,
                  sha256(l_orderkey || chr(31) || l_linenumber || chr(31) || l_linestatus) AS imported FROM lineitem)
SELECT l_orderkey, l_linenumber, seen AS last_seen_hash, CASE WHEN seen <> imported THEN 1 ELSE 0 END AS changed FROM r""")
def row_hash_delta(spark, d):
    c = F.col
    rows = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber",
        compare.row_hash(c("l_orderkey"), c("l_linenumber"), c("l_returnflag")).alias("last_seen_hash"),
        compare.row_hash(c("l_orderkey"), c("l_linenumber"), c("l_linestatus")).alias("last_imported_hash"),
    )
    return rows.withColumn("changed", delta.row_hash_delta(rows).cast("int")).drop("last_imported_hash")


@query("delta_export", f"""
WITH x AS ({_SYNC_SQL})
SELECT 'export' AS part, model, change FROM x WHERE change = 1 UNION ALL SELECT 'kept', model, CAST(0 AS INTEGER) FROM x""")
def delta_export(spark, d):
    exported, cleared = merge.delta_export(sync_entity(spark, d).select("model", "change"))
    return exported.select(F.lit("export").alias("part"), "*").unionByName(cleared.select(F.lit("kept").alias("part"), "*"))


@query("sync_duplicates", f"""
WITH n AS (SELECT o_custkey AS customer, o_orderstatus AS state, o_orderpriority AS priority, o_orderkey FROM orders),
o AS (SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN c_custkey + 100000000 ELSE c_custkey END AS customer, CASE WHEN c_acctbal > 3000 THEN 'F' ELSE 'O' END AS state,
             c_mktsegment AS priority, CAST(1 AS INTEGER) AS change, 'before' AS updated_at FROM customer),
m AS (SELECT *, lag(state) OVER w AS before, first(state) OVER w AS head, row_number() OVER (PARTITION BY customer ORDER BY o_orderkey DESC) AS r, count(*) OVER (PARTITION BY customer) AS k
      FROM n WINDOW w AS (PARTITION BY customer ORDER BY o_orderkey)),
l AS (SELECT *, coalesce(bool_or(before <> state) OVER (PARTITION BY customer), false) AS moved FROM m),
j AS (SELECT coalesce(l.customer, o.customer) AS customer, l.customer IS NOT NULL AS is_new, o.customer IS NOT NULL AS is_old, l.state AS new_state, l.priority AS new_priority,
             o.state AS old_state, o.priority AS old_priority, o.change AS old_change, o.updated_at AS old_at, l.before, l.k, l.moved, l.head
      FROM (SELECT * FROM l WHERE r = 1) l FULL JOIN o ON l.customer = o.customer),
a AS (SELECT *, CASE WHEN NOT is_new THEN 'kept' WHEN k = 1 AND NOT is_old THEN 'insert'
                     WHEN k > 1 THEN CASE WHEN before <> new_state THEN 'update' ELSE 'unchanged' END
                     WHEN new_state <> old_state THEN 'update' ELSE 'unchanged' END AS action FROM j)
SELECT customer, CASE WHEN is_new THEN new_state ELSE old_state END AS state, CASE WHEN is_new THEN new_priority ELSE old_priority END AS priority,
       CAST(CASE action WHEN 'kept' THEN old_change WHEN 'unchanged' THEN 0 ELSE 1 END AS INTEGER) AS change, action,
       CASE WHEN NOT is_new THEN old_at WHEN NOT is_old OR moved OR head <> old_state THEN '{NOW}' ELSE old_at END AS updated_at FROM a""")
def sync_duplicates(spark, d):
    key = F.col("c_custkey")
    target = table(spark, d, "customer").select(
        F.when(F.col("c_mktsegment") == "BUILDING", key + 100000000).otherwise(key).alias("customer"), F.when(F.col("c_acctbal") > 3000, "F").otherwise("O").alias("state"),
        F.col("c_mktsegment").alias("priority"), F.lit(1).alias("change"), F.lit("before").alias("updated_at"),
    )
    spec = sync.EntitySpec(
        name="customer", source="orders", target="customer", keys=("customer",), delta=("state",), order=("o_orderkey",),
        columns={"customer": F.col("o_custkey"), "state": F.col("o_orderstatus"), "priority": F.col("o_orderpriority")},
        on_insert={"change": 1, "updated_at": NOW}, on_changed={"change": 1, "updated_at": NOW}, on_unchanged={"change": 0},
    )
    return sync.classify_entity(spec, table(spark, d, "orders"), target)


@query("upsert_repeated", """
WITH r AS (SELECT o_custkey, o_orderstatus, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders)
SELECT coalesce(c_custkey, o_custkey) AS id, CASE WHEN o_custkey IS NULL THEN c_mktsegment ELSE o_orderstatus END AS state,
       CASE WHEN o_custkey IS NULL THEN c_acctbal ELSE o_totalprice END AS amount, c_name AS name
FROM (SELECT CASE WHEN c_custkey % 3 = 0 THEN c_custkey + 100000000 ELSE c_custkey END AS c_custkey, c_mktsegment, c_acctbal, c_name FROM customer)
FULL JOIN (SELECT * FROM r WHERE n = 1) ON c_custkey = o_custkey""")
def upsert_repeated(spark, d):
    """Changes in which most keys occur many times."""
    key = F.col("c_custkey")
    target = table(spark, d, "customer").select(
        F.when(key % 3 == 0, key + 100000000).otherwise(key).alias("id"), F.col("c_mktsegment").alias("state"), F.col("c_acctbal").alias("amount"), F.col("c_name").alias("name"),
    )
    changes = table(spark, d, "orders").select(
        F.col("o_custkey").alias("id"), F.col("o_orderstatus").alias("state"), F.col("o_totalprice").alias("amount"), "o_orderdate", "o_orderkey"
    )
    return merge.upsert(target, changes, ["id"], order=["o_orderdate", "o_orderkey"])


@query("orphans_many", """
WITH q AS (SELECT CASE WHEN o_orderstatus = 'F' AND o_totalprice > 250000 THEN o_custkey ELSE o_custkey + 100000000 END AS o_custkey, o_orderkey, o_orderpriority FROM orders),
r AS (SELECT o_custkey, o_orderpriority AS priority, lag(o_orderpriority) OVER w AS before, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS n
           FROM q WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)),
s AS (SELECT o_custkey, priority, before FROM r WHERE n = 1),
p AS (SELECT DISTINCT o_orderpriority AS priority FROM orders),
t AS (SELECT c_custkey AS id, CASE WHEN c_nationkey % 2 = 0 THEN '1-URGENT' ELSE 'none' || c_nationkey END AS priority, CAST(1 AS INTEGER) AS status, CAST(1 AS INTEGER) AS web FROM customer),
j AS (SELECT coalesce(t.id, s.o_custkey) AS id, coalesce(s.priority, t.priority) AS priority, t.status, t.web, s.o_custkey IS NOT NULL AS seen, t.id IS NOT NULL AS known,
             s.before IS NOT NULL AS again, s.priority <> coalesce(s.before, t.priority) AS differs FROM t FULL JOIN s ON t.id = s.o_custkey)
SELECT id, priority, CAST(CASE WHEN NOT seen THEN 0 ELSE status END AS INTEGER) AS status,
       CAST(CASE WHEN priority NOT IN (SELECT priority FROM p) AND web IS NOT NULL THEN 0 ELSE web END AS INTEGER) AS web,
       CASE WHEN NOT seen THEN 'orphan' WHEN NOT known AND NOT again THEN 'insert' WHEN differs THEN 'update' ELSE 'unchanged' END AS action FROM j""")
def orphans_many(spark, d):
    """Two policies, one by the merge key and one by another column; both look at every stored row."""
    target = table(spark, d, "customer").select(
        F.col("c_custkey").alias("id"),
        F.when(F.col("c_nationkey") % 2 == 0, "1-URGENT").otherwise(F.concat(F.lit("none"), F.col("c_nationkey").cast("string"))).alias("priority"),
        F.lit(1).alias("status"), F.lit(1).alias("web"),
    )
    spec = sync.EntitySpec(
        name="customer", source="orders", target="customer", keys=("id",), delta=("priority",), order=("o_orderkey",),
        columns={"id": F.col("id"), "priority": F.col("o_orderpriority")},
        orphans=(OrphanPolicy(("id",), {"status": 0}), OrphanPolicy(("priority",), {"web": 0})),
    )
    return sync.classify_entity(spec, _customers_of_large_orders(spark, d), target)


LINES_SQL = """
WITH n AS (SELECT l_orderkey || '-' || l_linenumber AS line, l_partkey AS part, round(l_extendedprice * (1 - l_discount) + 0.00003, 2) AS price, CAST(l_quantity AS BIGINT) AS amount,
                  row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_discount) AS r,
                  count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS k FROM lineitem),
o AS (SELECT l_orderkey || '-' || l_linenumber AS line, max(l_partkey) AS part, round(max(l_extendedprice * (1 - l_discount)) + 0.00003, 2) AS price,
             CAST(max(l_quantity) AS BIGINT) AS amount, CAST(1 AS INTEGER) AS status FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1),
x AS (SELECT 'gone-' || o_orderkey AS line, o_custkey AS part, o_totalprice AS price, CAST(0 AS BIGINT) AS amount, CAST(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS INTEGER) AS status FROM orders),
t AS (SELECT * FROM o UNION ALL SELECT * FROM x),
p AS (SELECT a.line, a.part, a.price, a.amount, a.k, b.price AS before_price, b.amount AS before_amount
      FROM n a LEFT JOIN n b ON a.line = b.line AND b.r = a.r - 1 WHERE a.r = a.k),
j AS (SELECT coalesce(p.line, t.line) AS line, p.line IS NOT NULL AS is_new, t.line IS NOT NULL AS is_old, p.part AS np, t.part AS op, p.price AS npr, t.price AS opr, p.amount AS na, t.amount AS oa,
             t.status AS os, k, before_price, before_amount FROM p FULL JOIN t ON p.line = t.line)
SELECT line, CASE WHEN is_new THEN np ELSE op END AS part, CASE WHEN is_new THEN npr ELSE opr END AS price, CASE WHEN is_new THEN na ELSE oa END AS amount,
       CAST(CASE WHEN is_new THEN 1 WHEN os = 1 THEN 0 ELSE os END AS INTEGER) AS status,
       CASE WHEN NOT is_new THEN CASE WHEN os = 1 THEN 'orphan' ELSE 'kept' END
            WHEN k > 1 THEN CASE WHEN before_price <> npr OR before_amount <> na THEN 'update' ELSE 'unchanged' END
            WHEN NOT is_old THEN 'insert' WHEN npr <> opr OR na <> oa THEN 'update' ELSE 'unchanged' END AS action
FROM j"""


def line_run(spark, d):
    """Spec, source and stored table of a run over lineitem: repeated keys, new, changed and gone rows."""
    lines, c = table(spark, d, "lineitem"), F.col
    key = F.concat_ws("-", c("l_orderkey"), c("l_linenumber"))
    price = lambda v: F.round(v + 0.00003, 2)
    net = c("l_extendedprice") * (1 - c("l_discount"))
    current = lines.where("l_returnflag <> 'N'").groupBy(key.alias("line")).agg(
        F.max("l_partkey").alias("part"), price(F.max(net)).alias("price"),
        F.max("l_quantity").cast("bigint").alias("amount"), F.lit(1).alias("status"),
    )
    gone = table(spark, d, "orders").select(
        F.concat(F.lit("gone-"), "o_orderkey").alias("line"), c("o_custkey").alias("part"), c("o_totalprice").alias("price"),
        F.lit(0).cast("bigint").alias("amount"), F.when(c("o_orderstatus") == "O", 1).otherwise(0).alias("status"),
    )
    spec = sync.EntitySpec(
        name="line", source="lines", target="line", keys=("line",), delta=("price", "amount"),
        order=("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_discount"),
        columns={"line": key, "part": c("l_partkey"), "price": price(net), "amount": c("l_quantity").cast("bigint"), "status": 1},
        orphans=(OrphanPolicy(("line",), {"status": 0}),),
    )
    return spec, lines, current.unionByName(gone)


@query("sync_lineitem", LINES_SQL)
def sync_lineitem(spark, d):
    """The article sync at the size of lineitem."""
    return sync.classify_entity(*line_run(spark, d))


def _tree_sql(path: str) -> str:
    slug = {n: sql_slug(f"{n}.name") for n in "abcd"}
    return f"""
WITH t AS ({cat.TREE}),
p AS (SELECT a.id, {slug['a']} AS path, 1 AS depth, a.parent FROM t a LEFT JOIN t u ON a.parent = u.id WHERE u.id IS NULL
      UNION ALL SELECT b.id, {slug['a']} || '/' || {slug['b']}, 2, b.parent FROM t b JOIN t a ON b.parent = a.id WHERE a.parent = '0'
      UNION ALL SELECT c.id, {slug['a']} || '/' || {slug['b']} || '/' || {slug['c']}, 3, c.parent FROM t c JOIN t b ON c.parent = b.id JOIN t a ON b.parent = a.id WHERE a.parent = '0'
      UNION ALL SELECT d.id, {slug['a']} || '/' || {slug['b']} || '/' || {slug['c']} || '/' || {slug['d']}, 4, d.parent
                FROM t d JOIN t c ON d.parent = c.id JOIN t b ON c.parent = b.id JOIN t a ON b.parent = a.id WHERE a.parent = '0')
{path}"""


@query("category_paths", _tree_sql("""
SELECT p.id, p.path, CAST(p.depth AS BIGINT) AS depth, coalesce(u.path, p.parent) AS parent_path,
       'de/' || coalesce(u.path, p.parent) AS parent_slug FROM p LEFT JOIN p u ON p.parent = u.id"""))
def category_paths(spark, d):
    nodes = cat.tree(spark, d)
    paths = tree.category_paths(nodes).checkpoint()
    rows = nodes.join(paths, "id").withColumn("parent_path", F.col("parent")).withColumn("parent_slug", F.col("parent"))
    rows = tree.category_slug(tree.category_path(rows, "parent_path", paths, "parent_path"), "parent_slug", paths, "parent_slug")
    return rows.select("id", "path", "depth", "parent_path", "parent_slug")


@query("meta_lookup", f"""
WITH t AS (SELECT upper(p_brand) || ' ' || p_type AS folder, CASE min(p_size) WHEN 1 THEN '  Alles zu {{{{Bezeichnung}}}}' || chr(10) || ' und {{{{bezeichnung}}}} ' ELSE '' END AS title
           FROM part GROUP BY p_brand, p_type),
r AS (SELECT p_partkey, p_brand || '/' || p_type AS name, CASE WHEN p_size > 25 THEN ' more  on {{{{Bezeichnung}}}}' ELSE ' ' END AS fallback FROM part),
k AS (SELECT {sql_slug('folder', '_', False, False)} AS key, trim(title, ' ' || chr(10)) AS title FROM t)
SELECT p_partkey, trim(regexp_replace(replace(replace(CASE WHEN title <> '' THEN title ELSE nullif(trim(fallback), '') END,
       '{{{{Bezeichnung}}}}', name), '{{{{bezeichnung}}}}', name), '\\s+', ' ', 'g')) AS meta_title
FROM r LEFT JOIN k ON {sql_slug('name', '_', False, False)} = key""")
def meta_lookup(spark, d):
    parts = table(spark, d, "part")
    texts = parts.groupBy("p_brand", "p_type").agg(F.min("p_size").alias("size")).select(
        F.concat(F.upper("p_brand"), F.lit(" "), "p_type").alias("folder"),
        F.when(F.col("size") == 1, "  Alles zu {{Bezeichnung}}\n und {{bezeichnung}} ").otherwise("").alias("Meta_Title"),
    )
    rows = parts.select(
        "p_partkey", F.concat("p_brand", F.lit("/"), "p_type").alias("name"),
        F.when(F.col("p_size") > 25, " more  on {{Bezeichnung}}").otherwise(" ").alias("fallback"),
    )
    found = lookups.category_meta(rows, texts, "name", "folder", "Meta_Title", "fallback", "meta_title")
    return found.select("p_partkey", "meta_title")


@query("article_slug", f"""
WITH i AS ({cat.INCOMING}), o AS ({cat.STORED}), c AS ({cat.CATEGORIES}),
r AS (SELECT i.article_no, i.title, s.seo_slug AS own, CASE WHEN trim(i.master) <> '' AND lower(trim(i.master)) <> 'master' THEN m.category END AS master_category,
             c.id AS category
      FROM i LEFT JOIN o s ON i.article_no = s.model LEFT JOIN o m ON trim(i.master) = m.model LEFT JOIN c ON trim(i.category_code) = c.source_id),
w AS (SELECT r.*, c.seo_slug AS path FROM r LEFT JOIN c ON coalesce(master_category, category) = c.id)
SELECT article_no, CASE WHEN trim(coalesce(own, '')) <> '' THEN own
       ELSE coalesce(path, 'de') || '/' || {sql_slug('title', words=False, accents=False)} END AS seo_slug FROM w""")
def article_slug(spark, d):
    rows = lookups.article_slug(
        cat.incoming(spark, d), cat.stored(spark, d), cat.categories(spark, d), "article_no", "category_code", "title", "master"
    )
    return rows.select("article_no", "seo_slug")


@query("unique_slugs", f"""
WITH t AS (SELECT DISTINCT {cat.SLUG_OF_PART} AS slug FROM part WHERE p_type = 'ECONOMY' AND p_size > 40
           UNION SELECT DISTINCT {cat.SLUG_OF_PART} || '-2' FROM part WHERE p_type = 'PROMO' AND p_size > 30
           UNION SELECT DISTINCT {cat.SLUG_OF_PART} || '-3' FROM part WHERE p_type = 'LARGE'),
r AS (SELECT p_partkey, {cat.SLUG_OF_PART} AS base, row_number() OVER (PARTITION BY {cat.SLUG_OF_PART} ORDER BY p_partkey) AS k FROM part),
b AS (SELECT base, max(k) AS n FROM r GROUP BY base),
g AS (SELECT base, unnest(generate_series(0, n + 3)) AS slot FROM b),
f AS (SELECT base, CASE WHEN slot = 0 THEN base ELSE base || '-' || slot END AS slug, row_number() OVER (PARTITION BY base ORDER BY slot) AS k
      FROM g WHERE CASE WHEN slot = 0 THEN base ELSE base || '-' || slot END NOT IN (SELECT slug FROM t))
SELECT p_partkey, slug AS seo_slug FROM r JOIN f USING (base, k)""")
def unique_slugs(spark, d):
    parts = table(spark, d, "part")
    slug = text.slugify(F.col("p_name"))
    taken = (
        parts.where("p_type = 'ECONOMY' and p_size > 40").select(slug.alias("slug"))
        .union(parts.where("p_type = 'PROMO' and p_size > 30").select(F.concat(slug, F.lit("-2"))))
        .union(parts.where("p_type = 'LARGE'").select(F.concat(slug, F.lit("-3"))))
    )
    rows = parts.select("p_partkey", slug.alias("seo_slug"), F.col("p_partkey").alias("ordinal"))
    return slugs.unique_slugs(rows, taken, ["p_partkey"])


# row by row: the working table holds the last row of each status, the keyed table all slugs given so far
@query("slug_collisions", """
WITH RECURSIVE r AS (
  SELECT o_orderkey, lower(o_orderstatus) AS family, lower(o_orderstatus) || CASE WHEN o_totalprice > 250000 THEN '-' || (o_custkey % 100) ELSE '' END AS base,
         row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS k FROM orders
), taken AS (SELECT 'f-' || (c_custkey * 3) AS slug FROM customer),
given(seo_slug, o_orderkey, family, base, slot, k) USING KEY (seo_slug) AS (
  SELECT '*' || family, CAST(NULL AS BIGINT), family, CAST(NULL AS VARCHAR), CAST(-1 AS BIGINT), CAST(0 AS BIGINT) FROM (SELECT DISTINCT family FROM r)
  UNION
  SELECT slug, o_orderkey, family, base, slot, k FROM (
    SELECT r.o_orderkey, r.family, r.base, r.k, c.slot, CASE WHEN c.slot = 0 THEN r.base ELSE r.base || '-' || c.slot END AS slug,
           row_number() OVER (PARTITION BY r.family ORDER BY c.slot) AS n
    FROM given g JOIN r ON r.family = g.family AND r.k = g.k + 1
      LEFT JOIN (SELECT base, max(slot) AS top FROM recurring.given WHERE base IS NOT NULL GROUP BY base) m ON m.base = r.base,
      LATERAL (SELECT unnest(range(coalesce(m.top, -1) + 1, coalesce(m.top, -1) + 402)) AS slot) c
    WHERE CASE WHEN c.slot = 0 THEN r.base ELSE r.base || '-' || c.slot END NOT IN (SELECT slug FROM taken)
      AND CASE WHEN c.slot = 0 THEN r.base ELSE r.base || '-' || c.slot END NOT IN (SELECT seo_slug FROM recurring.given)) WHERE n = 1
)
SELECT o_orderkey, seo_slug FROM given WHERE o_orderkey IS NOT NULL""")
def slug_collisions(spark, d):
    """Names that end in numbers of their own, so that bases and numbered slugs meet."""
    orders = table(spark, d, "orders")
    name = F.concat_ws("-", F.col("o_orderstatus"), F.when(F.col("o_totalprice") > 250000, F.col("o_custkey") % 100))
    rows = orders.select("o_orderkey", text.slugify(name).alias("seo_slug"), F.col("o_orderkey").alias("ordinal"))
    taken = table(spark, d, "customer").select(F.concat(F.lit("f-"), (F.col("c_custkey") * 3).cast("string")).alias("slug"))
    return slugs.unique_slugs(rows, taken, ["o_orderkey"])


@query("run_totals", f"""
WITH {_JOINED}
SELECT CAST(2 * count(*) FILTER (is_new) AS BIGINT) AS processed, CAST(1 AS BIGINT) AS errors,
       CAST(floor(2 * 100 / 3) AS BIGINT) AS percent FROM s""")
def run_totals(spark, d):
    """Two runs of the article entity over a stored table, and one entity that fails."""
    store = SnapshotStore(spark, scratch(spark, "run-totals"))
    store.write("article", cat.stored(spark, d).select("model", "name", "price", "tax_class", "status", "change", "updated_at"))
    specs = [article_spec(), article_spec(name="again"), article_spec(name="broken", source="missing")]
    stats = sync.run_entities(spark, specs, {"articles": lambda: cat.incoming(spark, d)}, store)
    done = F.lit(2).cast("bigint")
    return sync.run_totals(stats).withColumn("percent", run_log.progress_percent(done, F.lit(3)))


@query("truncate_all", """
SELECT 'customer' AS "table", (SELECT count(*) FROM customer) AS removed, CAST(0 AS BIGINT) AS left_over
UNION ALL SELECT 'supplier', (SELECT count(*) FROM supplier), CAST(0 AS BIGINT)""")
def truncate_all(spark, d):
    """Two stored tables emptied: rows removed, and rows left."""
    store = SnapshotStore(spark, scratch(spark, "truncate"))
    for name in ("customer", "supplier"):
        store.write(name, table(spark, d, name))
    removed = store.truncate_all()
    left = table_counts(store.tables()).select("table", F.col("rows").alias("left_over"))
    return removed.join(left, "table")


@query("distinct_masters", f"""
WITH i AS ({cat.INCOMING}), o AS ({cat.STORED})
SELECT m AS master_model, CAST(count(*) AS BIGINT) AS variants, CAST(count(o.model) AS BIGINT) AS resolved
FROM (SELECT trim(master) AS m FROM i WHERE trim(master) <> '' AND lower(trim(master)) <> 'master') LEFT JOIN o ON o.model = m GROUP BY m""")
def distinct_masters(spark, d):
    named = cat.incoming(spark, d).select(logic.article_master_number(F.col("master")).alias("master_model"))
    named = named.where("master_model is not null").withColumn("found", F.col("master_model"))
    ids = cat.stored(spark, d).select("model", "id")
    return lookups.resolve_fk(named, "found", ids, "model").groupBy("master_model").agg(
        F.count("*").alias("variants"), F.count("found").alias("resolved")
    )

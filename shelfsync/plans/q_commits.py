"""Queries for tables in buckets, transactions over several tables, refused rows and enforced constraints."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import registry, text
from ..operators import enforce, merge, rejects, sync
from ..sources.commits import TableStore
from . import catalog as cat
from .base import query, scratch, table
from .q_sync import LINES_SQL, line_run

BUCKETS = 32


@query("sync_lineitem_buckets", f"SELECT line, part, price, amount, status FROM ({LINES_SQL})")
def sync_lineitem_buckets(spark, d):
    """The run over lineitem, into a table that is kept in buckets of its key."""
    spec, lines, stored = line_run(spark, d)
    store = TableStore(spark, scratch(spark, "line-buckets"))
    store.create("line", stored, ["line"], BUCKETS)
    sync.run_entity(spec, lines, store)
    return store.read("line")


_STOCK_SQL = f"""
i AS (SELECT 'P' || (n_nationkey * 7) AS model, n_name AS name, CAST(n_regionkey AS DOUBLE) AS price FROM nation),
o AS (SELECT 'P' || p_partkey AS model, p_name AS name, p_retailprice AS price, CAST(1 AS INTEGER) AS change FROM part)
SELECT coalesce(i.model, o.model) AS model, coalesce(i.name, o.name) AS name, coalesce(i.price, o.price) AS price,
       CAST(CASE WHEN i.model IS NULL THEN change WHEN o.model IS NULL OR i.price <> o.price THEN 2 ELSE 0 END AS INTEGER) AS change
FROM o FULL JOIN i ON o.model = i.model"""


@query("bucket_sync", f"WITH {_STOCK_SQL}")
def bucket_sync(spark, d):
    """Few changes to a table in buckets: only the buckets of their keys are read and written."""
    store = TableStore(spark, scratch(spark, "stock"))
    stored = table(spark, d, "part").select(
        F.concat(F.lit("P"), "p_partkey").alias("model"), F.col("p_name").alias("name"), F.col("p_retailprice").alias("price"), F.lit(1).alias("change")
    )
    store.create("stock", stored, ["model"], 4 * BUCKETS)
    spec = sync.EntitySpec(
        name="stock", source="nation", target="stock", keys=("model",), delta=("price",),
        columns={"model": F.concat(F.lit("P"), F.col("n_nationkey") * 7), "name": F.col("n_name"), "price": F.col("n_regionkey").cast("double")},
        on_insert={"change": 2}, on_changed={"change": 2}, on_unchanged={"change": 0},
    )
    sync.run_entity(spec, table(spark, d, "nation"), store)
    return store.read("stock")


@query("blind_upsert", """
WITH r AS (SELECT o_custkey, o_orderstatus, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders),
s AS (SELECT s_suppkey * 3 AS id, s_name FROM supplier)
SELECT coalesce(c_custkey, o_custkey, s.id) AS id, CASE WHEN o_custkey IS NULL THEN c_mktsegment ELSE o_orderstatus END AS state,
       CASE WHEN o_custkey IS NULL THEN c_acctbal ELSE o_totalprice END AS amount, CASE WHEN s.id IS NOT NULL THEN s_name ELSE c_name END AS name
FROM customer FULL JOIN (SELECT * FROM r WHERE n = 1) ON c_custkey = o_custkey FULL JOIN s ON s.id = coalesce(c_custkey, o_custkey)""")
def blind_upsert(spark, d):
    """Two runs that are added without a look at the stored rows, each setting other columns."""
    store = TableStore(spark, scratch(spark, "blind"))
    c = F.col
    stored = table(spark, d, "customer").select(
        c("c_custkey").alias("id"), c("c_mktsegment").alias("state"), c("c_acctbal").alias("amount"), c("c_name").alias("name")
    )
    store.create("account", stored, ["id"], BUCKETS)
    orders = sync.EntitySpec(
        name="order", source="orders", target="account", keys=("id",), order=("o_orderdate", "o_orderkey"),
        columns={"id": c("o_custkey"), "state": c("o_orderstatus"), "amount": c("o_totalprice")},
    )
    names = sync.EntitySpec(name="name", source="supplier", target="account", keys=("id",), columns={"id": c("s_suppkey") * 3, "name": c("s_name")})
    sync.run_entity(orders, table(spark, d, "orders"), store)
    sync.run_entity(names, table(spark, d, "supplier"), store)
    return store.read("account")


_BRANDS_SQL = """
SELECT p_brand AS brand, max_by(p_name, p_partkey) AS newest FROM part GROUP BY p_brand"""


@query("multi_target", f"""
WITH i AS ({cat.INCOMING}), o AS ({cat.STORED}), b AS ({_BRANDS_SQL}),
n AS (SELECT article_no AS model, trim(title) AS name, brand FROM i),
j AS (SELECT coalesce(n.model, o.model) AS model, coalesce(n.name, o.name) AS name, n.brand,
             CAST(CASE WHEN n.model IS NULL THEN o.change WHEN o.model IS NULL OR n.name <> o.name THEN 1 ELSE 0 END AS INTEGER) AS change
      FROM n FULL JOIN (SELECT * FROM o) o ON n.model = o.model)
SELECT 'article' AS "table", model AS key, name, change FROM j
UNION ALL SELECT 'brand', brand, newest, CAST(1 AS INTEGER) FROM b""")
def multi_target(spark, d):
    """Articles and their brands from one scan of the source, committed together."""
    store = TableStore(spark, scratch(spark, "multi"))
    c = F.col
    store.write("article", cat.stored(spark, d).select("model", "name", "change"))
    store.write("brand", spark.createDataFrame([], "brand string, newest string, change int"))
    title = registry.pipe(c("title"), text.trim)
    flags = dict(on_insert={"change": 1}, on_changed={"change": 1}, on_unchanged={"change": 0})
    specs = [
        sync.EntitySpec(name="article", source="articles", target="article", keys=("model",), delta=("name",), columns={"model": c("article_no"), "name": title}, **flags),
        sync.EntitySpec(name="brand", source="articles", target="brand", keys=("brand",), order=("number",), columns={"brand": c("brand"), "newest": title}, on_insert={"change": 1}),
    ]
    source = cat.incoming(spark, d).withColumn("number", F.substring("article_no", 2, 20).cast("bigint"))
    sync.run_targets(specs, source, store)
    article = store.read("article").select(F.lit("article").alias("table"), F.col("model").alias("key"), "name", "change")
    brand = store.read("brand").select(F.lit("brand").alias("table"), F.col("brand").alias("key"), F.col("newest").alias("name"), "change")
    return article.unionByName(brand)


# Prices as text, some of which are no numbers.
_DIRTY_SQL = """
d AS (SELECT o_custkey AS id, o_orderkey, CASE WHEN o_orderpriority LIKE '1%' THEN 'unknown' WHEN o_orderpriority LIKE '2%' THEN NULL ELSE CAST(o_totalprice AS VARCHAR) END AS amount,
             CASE WHEN o_orderstatus = 'P' THEN 'none' ELSE CAST(o_orderkey % 7 AS VARCHAR) END AS rank FROM orders),
g AS (SELECT * FROM d WHERE (amount IS NULL OR amount <> 'unknown') AND rank <> 'none')"""


def _dirty(spark, d):
    priority = F.col("o_orderpriority")
    return table(spark, d, "orders").select(
        F.col("o_custkey").alias("id"), "o_orderkey",
        F.when(priority.startswith("1"), "unknown").when(~priority.startswith("2"), F.col("o_totalprice").cast("string")).alias("amount"),
        F.when(F.col("o_orderstatus") == "P", "none").otherwise((F.col("o_orderkey") % 7).cast("string")).alias("rank"),
    )


def _accounts(spark, d):
    return table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("amount"), F.col("c_nationkey").alias("rank"))


@query("upsert_rejects", f"""
WITH {_DIRTY_SQL},
l AS (SELECT * FROM g QUALIFY row_number() OVER (PARTITION BY id ORDER BY o_orderkey DESC) = 1)
SELECT 'row' AS part, coalesce(c_custkey, l.id) AS id, CASE WHEN l.id IS NULL THEN c_acctbal ELSE CAST(l.amount AS DOUBLE) END AS amount,
       CAST(CASE WHEN l.id IS NULL THEN c_nationkey ELSE CAST(l.rank AS INTEGER) END AS INTEGER) AS rank, CAST(NULL AS VARCHAR) AS "column", CAST(NULL AS VARCHAR) AS value,
       CAST(NULL AS VARCHAR) AS reason, CAST(1 AS BIGINT) AS times
FROM customer FULL JOIN l ON c_custkey = l.id
UNION ALL SELECT 'reject', id, NULL, NULL, 'amount', amount, 'not a double', count(*) FROM d WHERE amount = 'unknown' GROUP BY id, amount
UNION ALL SELECT 'reject', id, NULL, NULL, 'rank', rank, 'not a int', count(*) FROM d WHERE rank = 'none' GROUP BY id, rank""")
def upsert_rejects(spark, d):
    """Changes of which some do not fit: none overwrites a stored value, all are listed."""
    target, changes = _accounts(spark, d), _dirty(spark, d)
    merged = merge.upsert(target, changes, ["id"], order=["o_orderkey"]).withColumn("times", F.lit(1).cast("bigint"))
    refused = rejects.rejects(changes.drop("o_orderkey"), target, ["id"], "orders")
    refused = refused.groupBy(F.get_json_object("row", "$.id").cast("bigint").alias("id"), "column", "value", "reason").agg(F.count("*").alias("times"))
    return merged.withColumn("part", F.lit("row")).unionByName(refused.withColumn("part", F.lit("reject")), allowMissingColumns=True)


@query("sync_row_stats", f"""
WITH {_DIRTY_SQL},
o AS (SELECT CASE WHEN c_nationkey < 8 THEN c_custkey + 100000000 ELSE c_custkey END AS id, c_acctbal AS amount FROM customer),
n AS (SELECT g.*, CAST(g.amount AS DOUBLE) AS now, lag(CAST(g.amount AS DOUBLE)) OVER w AS before, row_number() OVER w AS k FROM g WINDOW w AS (PARTITION BY id ORDER BY o_orderkey)),
s AS (SELECT CASE WHEN k > 1 THEN CASE WHEN now IS DISTINCT FROM before THEN 'updated' ELSE 'unchanged' END WHEN o.id IS NULL THEN 'inserted'
                  WHEN now IS DISTINCT FROM o.amount THEN 'updated' ELSE 'unchanged' END AS step, n.id, o.id AS known FROM n LEFT JOIN o ON n.id = o.id)
SELECT (SELECT count(*) FROM orders) AS processed, (SELECT count(*) FROM orders) - (SELECT count(*) FROM g) AS errors,
       count(*) FILTER (step = 'inserted') AS inserted, count(*) FILTER (step = 'updated') AS updated, count(*) FILTER (step = 'unchanged') AS unchanged,
       CAST(count(DISTINCT id) FILTER (known IS NULL) AS BIGINT) AS new_rows, CAST(count(DISTINCT id) FILTER (known IS NOT NULL) AS BIGINT) AS known_rows FROM s""")
def sync_row_stats(spark, d):
    """Statistics by source row and by target row, where most keys repeat and some rows do not fit."""
    key = F.when(F.col("rank") < 8, F.col("id") + 100000000).otherwise(F.col("id"))
    target = _accounts(spark, d).withColumn("id", key)
    spec = sync.EntitySpec(
        name="account", source="orders", target="account", keys=("id",), delta=("amount",), order=("o_orderkey",),
        columns={"id": F.col("id"), "amount": F.col("amount"), "rank": F.col("rank")},
    )
    rows = sync.typed(spec, sync.map_entity(spec, _dirty(spark, d), {}), target).checkpoint()
    counts = sync.row_stats(sync.key_steps(spec, rows, target)).withColumn("one", F.lit(1))
    intake = rows.agg(F.count("*").alias("processed"), F.count_if("__bad").alias("errors")).withColumn("one", F.lit(1))
    return intake.join(counts, "one").drop("one")


@query("enforced_write", """
WITH o AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 11 = 0 THEN o_custkey + 100000000 ELSE o_custkey END AS customer, o_orderstatus || '/' || (o_orderkey // 3) AS number,
                  CASE WHEN o_orderpriority LIKE '5%' THEN NULL ELSE o_totalprice END AS amount FROM orders),
b AS (SELECT *, amount < 1500 AS low, amount IS NULL AS empty, customer NOT IN (SELECT c_custkey FROM customer) AS dangling FROM o),
u AS (SELECT *, NOT coalesce(low, false) AND NOT empty AS fit,
             coalesce(row_number() OVER (PARTITION BY number, NOT coalesce(low, false) AND NOT empty ORDER BY id) > 1, false) AND NOT coalesce(low, false) AND NOT empty AS again FROM b)
SELECT id, customer, number, amount, array_to_string(list_filter([CASE WHEN empty THEN 'amount filled' END, CASE WHEN low THEN 'amount high' END, CASE WHEN dangling THEN 'customer known' END,
       CASE WHEN again THEN 'number unique' END], lambda x: x IS NOT NULL), ',') AS broken FROM u""")
def enforced_write(spark, d):
    """Orders written under checks, a unique key and a reference; rows that break a rule are kept apart with its name."""
    store = TableStore(spark, scratch(spark, "enforced"))
    key, c = F.col("o_orderkey"), F.col
    store.write("customer", table(spark, d, "customer").select("c_custkey"))
    rows = table(spark, d, "orders").select(
        key.alias("id"), F.when(key % 11 == 0, c("o_custkey") + 100000000).otherwise(c("o_custkey")).alias("customer"),
        F.concat_ws("/", "o_orderstatus", F.floor(key / 3).cast("string")).alias("number"),
        F.when(~c("o_orderpriority").startswith("5"), c("o_totalprice")).alias("amount"),
    )
    rules = enforce.Constraints(
        checks={"amount filled": c("amount").isNotNull(), "amount high": c("amount") >= 1500},
        unique={"number unique": ["number"]}, references={"customer known": ("customer", "customer", "c_custkey")},
    )
    enforce.enforced_write(store, "orders", rows, rules, ["id"], enforce.QUARANTINE)
    refused = store.read("orders__refused").withColumn("broken", F.array_join("broken_rules", ",")).drop("broken_rules")
    return store.read("orders").withColumn("broken", F.lit("")).unionByName(refused)

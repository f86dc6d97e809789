"""Entity runs: idempotence, orphans, duplicates, failures, and the staging run end to end."""

import random

import pytest
from pyspark.sql import functions as F

from shelfsync.operators import sync
from shelfsync.operators.orphans import OrphanPolicy, anti_join_orphans, orphan_update
from shelfsync.operators.schema import create_table
from shelfsync.plans.staging import STAGING_TABLES, article_run_order, stage_entities
from shelfsync.operators.tree import category_paths
from shelfsync.sources.snapshots import SnapshotStore

NOW = "2024-06-01T00:00:00+00:00"


def spec(**more):
    base = dict(
        name="item", source="items", target="item", keys=("model",), delta=("name", "price"),
        columns={"model": F.trim("no"), "name": F.col("label"), "price": F.col("cost")},
        on_insert={"change": 1, "touched": NOW}, on_changed={"change": 1, "touched": NOW}, on_unchanged={"change": 0},
        orphans=(OrphanPolicy(("model",), {"status": 0, "change": 1}),),
    )
    return sync.EntitySpec(**{**base, **more})


SOURCE = "no string, label string, cost string"
TARGET = "model string, name string, price string, status int, change int, touched string"


@pytest.fixture
def store(spark, tmp_path):
    return SnapshotStore(spark, str(tmp_path / "tables"))


def rows(df, key="model"):
    return {r[key]: r.asDict() for r in df.collect()}


def test_first_second_and_third_run(spark, store):
    source = spark.createDataFrame([("a", "A", "1.0"), (" b ", "B", "2"), (" ", "skipped", "3")], SOURCE)
    store.write("item", spark.createDataFrame([("b", "B", "2.00", 1, 1, None), ("old", "O", "9", 1, 0, "t")], TARGET))
    first = sync.run_entity(spec(), source, store)
    assert first == {"processed": 3, "skipped": 1, "errors": 0, "inserted": 1, "updated": 0, "unchanged": 1, "orphans": 1}
    table = rows(store.read("item"))
    assert table["a"] == {"model": "a", "name": "A", "price": "1.0", "status": None, "change": 1, "touched": NOW}
    assert table["b"]["change"] == 0 and table["b"]["touched"] is None
    assert (table["old"]["status"], table["old"]["change"], table["old"]["name"]) == (0, 1, "O")
    second = sync.run_entity(spec(), source, store)
    assert (second["inserted"], second["updated"], second["unchanged"], second["orphans"]) == (0, 0, 2, 0)
    before = rows(store.read("item"))
    sync.run_entity(spec(), source, store)
    assert rows(store.read("item")) == before


def test_result_does_not_depend_on_partitions(spark):
    draw = random.Random(5)
    source = spark.createDataFrame([(f"k{i}", draw.choice("xyz"), str(i % 4)) for i in range(300)], SOURCE)
    target = spark.createDataFrame([(f"k{i}", draw.choice("xyz"), str(i % 4), 1, 0, None) for i in range(150, 400)], TARGET)
    results = [rows(sync.classify_entity(spec(), source.repartition(n), target.repartition(n))) for n in (1, 7)]
    assert results[0] == results[1] and len(results[0]) == 400


def one_by_one(source, target):
    """The rule applied row by row, for one key and one delta field."""
    table = {k: dict(v) for k, v in target.items()}
    actions = {}
    for key, value, _ in sorted(source, key=lambda r: r[2]):
        stored = table.get(key)
        row = dict(stored) if stored else {"value": None, "change": None, "touched": None}
        changed = stored is None or stored["value"] != value
        row["value"] = value
        row["change"] = 1 if changed else 0
        if changed:
            row["touched"] = NOW
        table[key] = row
        actions[key] = "insert" if stored is None else "update" if changed else "unchanged"
    return table, actions


def test_repeated_keys_follow_the_run(spark):
    draw = random.Random(11)
    source = [(f"k{draw.randrange(30)}", draw.choice("ab"), i) for i in range(50)] + [("k1", "a", 100 + i) for i in range(40)]
    target = {f"k{i}": {"value": draw.choice("ab"), "change": 1, "touched": None} for i in range(10, 40)}
    entity = sync.EntitySpec(
        name="x", source="x", target="x", keys=("key",), delta=("value",), order=("at",),
        columns={"key": F.col("key"), "value": F.col("value")},
        on_insert={"change": 1, "touched": NOW}, on_changed={"change": 1, "touched": NOW}, on_unchanged={"change": 0},
    )
    left = spark.createDataFrame(source, "key string, value string, at int").repartition(5)
    right = spark.createDataFrame([(k, v["value"], v["change"], v["touched"]) for k, v in target.items()], "key string, value string, change int, touched string")
    expected, actions = one_by_one(source, target)
    found = rows(sync.classify_entity(entity, left, right), "key")
    wanted = {k: (r["value"], r["change"], r["touched"]) for k, r in expected.items()}
    assert {k: (r["value"], r["change"], r["touched"]) for k, r in found.items()} == wanted
    assert {k: r["action"] for k, r in found.items() if r["action"] != "kept"} == actions


def test_a_value_that_changes_and_changes_back_leaves_its_stamp(spark):
    entity = spec(columns={"model": F.col("no"), "name": F.col("label"), "price": F.col("cost")}, order=("at",))
    target = spark.createDataFrame([("k", "A", "1", 1, 1, "old"), ("l", "A", "1", 1, 1, "old")], TARGET)
    source = spark.createDataFrame([("k", "B", "1", 1), ("k", "A", "1.0", 2), ("k", "A", "01", 3), ("l", "A", "1.00", 4), ("l", "A", "+1", 5)], SOURCE + ", at int")
    found = rows(sync.classify_entity(entity, source, target))
    assert (found["k"]["action"], found["k"]["touched"], found["k"]["change"]) == ("unchanged", NOW, 0)
    assert (found["l"]["action"], found["l"]["touched"], found["l"]["change"]) == ("unchanged", "old", 0)


def test_repeated_keys_without_an_order(spark):
    entity = spec(surrogate="id")
    target = spark.createDataFrame([("old", "O", "9", 1, 0, "t", 4)], TARGET + ", id bigint")
    source = spark.createDataFrame([("a", "B", "1"), ("a", "A", "1"), ("n", "N", "2"), ("n", "N", "2"), ("old", "O", "9.0")], SOURCE)
    for parts in (1, 5):
        found = sync.classify_entity(entity, source.repartition(parts), target).collect()
        assert sorted((r["model"], r["name"], r["id"]) for r in found) == [("a", "B", 5), ("n", "N", 6), ("old", "O", 4)]


def test_rows_that_do_not_fit_are_errors(spark, store):
    kind = "model string, name string, price double, status int, change int, touched string"
    store.write("item", spark.createDataFrame([("a", "A", 1.0, 1, 0, "t"), ("b", "B", 2.0, 1, 0, "t"), ("gone", "G", 3.0, 1, 0, "t")], kind))
    source = spark.createDataFrame([("a", "A", "x"), ("a", "A2", "7"), ("a", "A3", "y"), ("b", "B", "none"), ("new", "N", "-"), (" ", "S", "1"), ("c", "C", "4.5")], SOURCE)
    stats = sync.run_entity(spec(), source, store)
    assert stats == {"processed": 7, "skipped": 1, "errors": 4, "inserted": 1, "updated": 1, "unchanged": 0, "orphans": 1}
    found = rows(store.read("item"))
    assert set(found) == {"a", "b", "c", "gone"}
    assert (found["a"]["name"], found["a"]["price"]) == ("A2", 7.0) and found["b"] == {"model": "b", "name": "B", "price": 2.0, "status": 1, "change": 0, "touched": "t"}
    assert found["gone"]["status"] == 0
    intake = sync.intake_stats(spec(), source, target=store.read("item")).first()
    assert (intake["processed"], intake["skipped"], intake["errors"]) == (7, 1, 4)


def test_rows_dropped_on_the_way_are_skipped(spark, store):
    from shelfsync.operators.mapping import fill_file_name

    store.write("item", spark.createDataFrame([], "file_name string, hash string"))
    entity = sync.EntitySpec(name="f", source="f", target="item", keys=("file_name",), columns={"file_name": F.col("file_name"), "hash": F.col("hash")},
                             prepare=lambda r, t: fill_file_name(r))
    source = spark.createDataFrame([("x", None), ("", ""), (None, " ")], "file_name string, hash string")
    stats = sync.run_entity(entity, source, store)
    assert (stats["processed"], stats["skipped"], stats["inserted"]) == (3, 2, 1)


def test_every_policy_looks_at_every_stored_row(spark):
    target = spark.createDataFrame([("a", "A", "1", 1, 1, "t"), ("b", "L1", "1", 1, 1, "t"), ("c", "L2", "1", 1, 1, "t")], TARGET)
    source = spark.createDataFrame([("a", "L1", "1")], SOURCE)
    entity = spec(on_insert={}, on_changed={}, on_unchanged={}, orphans=(OrphanPolicy(("model",), {"status": 0}), OrphanPolicy(("name",), {"change": 0})))
    found = rows(sync.classify_entity(entity, source, target))
    assert {k: (r["status"], r["change"], r["action"]) for k, r in found.items()} == {"a": (1, 1, "update"), "b": (0, 1, "orphan"), "c": (0, 0, "orphan")}


def test_plan_grows_with_the_policies_only(spark, tmp_path):
    spark.createDataFrame([("a", "L1", "1")], SOURCE).write.parquet(str(tmp_path / "s"))
    spark.createDataFrame([("a", "A", "1", 1, 1, "t")], TARGET).write.parquet(str(tmp_path / "t"))
    scans = []
    for n in range(5):
        policies = tuple(OrphanPolicy(("name",), {"status": i}) for i in range(n))
        plan = sync.classify_entity(spec(orphans=policies), spark.read.parquet(str(tmp_path / "s")), spark.read.parquet(str(tmp_path / "t")))
        scans.append(str(plan._jdf.queryExecution().optimizedPlan().toString()).count("Relation ["))
    assert len({b - a for a, b in zip(scans, scans[1:])}) == 1


def test_an_error_without_text_does_not_end_the_run(spark, store):
    store.write("item", spark.createDataFrame([], TARGET))

    def silent():
        raise ValueError

    source = spark.createDataFrame([("a", "A", "1")], SOURCE)
    stats = rows(sync.run_entities(spark, [spec(name="bad", source="bad"), spec()], {"bad": silent, "items": lambda: source}, store), "entity")
    assert stats["bad"]["error"] == "ValueError()" and stats["item"]["inserted"] == 1


def test_empty_run_is_refused(spark):
    source = spark.createDataFrame([], SOURCE)
    target = spark.createDataFrame([("a", "A", "1", 1, 0, None)], TARGET)
    with pytest.raises(ValueError):
        sync.classify_entity(spec(), source, target)
    forced = spec(orphans=(OrphanPolicy(("model",), {"status": 0}, allow_empty=True),))
    assert sync.classify_entity(forced, source, target).first()["action"] == "orphan"
    with pytest.raises(ValueError):
        orphan_update(target, target.limit(0), [OrphanPolicy(("model",), {"status": 0})])


def test_orphans_twice_is_once(spark):
    target = spark.createDataFrame([("a", "A", "1", 1, 0, None), (None, "N", "1", 1, 0, None), ("b", "B", "1", 1, 0, None)], TARGET)
    seen = target.where("model = 'a'")
    policy = OrphanPolicy(("model",), {"status": 0, "change": 1})
    once = orphan_update(target, seen, [policy])
    assert once.where("orphaned").select("model").collect() == [("b",)]
    assert orphan_update(once.drop("orphaned"), seen, [policy]).where("orphaned").count() == 0
    assert [r["model"] for r in anti_join_orphans(target, seen, ["model"]).collect()] == ["b"]


def test_failed_entity_is_reported(spark, store):
    store.write("item", spark.createDataFrame([], TARGET))
    source = spark.createDataFrame([("a", "A", "1")], SOURCE)
    entities = [spec(name="bad", source="nowhere"), spec(), spec(name="left_out")]
    stats = rows(sync.run_entities(spark, entities, {"items": lambda: source}, store, ["bad", "item"]), "entity")
    assert set(stats) == {"bad", "item"}
    assert stats["bad"]["error"] and stats["item"]["inserted"] == 1 and stats["item"]["error"] is None


def test_run_order():
    assert sync.run_order(["media", "article", "attribute", "category"]) == ["category", "article", "attribute", "media"]


def test_incomplete_snapshot_is_ignored(spark, store, tmp_path):
    store.write("item", spark.createDataFrame([("a", "A", "1", 1, 0, None)], TARGET))
    (tmp_path / "tables" / "item" / "snapshot=00000002").mkdir()
    assert store.read("item").count() == 1
    store.write("item", store.read("item").limit(0))
    assert store.read("item").count() == 0
    assert rows(store.truncate_all(), "table")["item"]["removed"] == 0


ARTICLES = [
    # Artikel, Artikelnummer, Bezeichnung, VK3, Warengruppe, Umsatzsteuer, Zusatzfeld07, Zusatzfeld03, Zusatzfeld15
    ("1", "A1", " Hose Größe ", "10,50", "7", "19", "Master", "Farbe", "rot"),
    ("2", "A2", "Hose Größe", "11", "8", "7", "A1", "Farbe", "blau"),
    ("3", "A3", "Hose Größe", "x", "7", "0", "", " ", "egal"),
    ("4", " ", "ohne Nummer", "1", "7", "19", "", "Größe", "L"),
]


def article_source(spark):
    names = "Artikel Artikelnummer Bezeichnung VK3 Warengruppe Umsatzsteuer Zusatzfeld07 Zusatzfeld03 Zusatzfeld15".split()
    df = spark.createDataFrame(ARTICLES, ", ".join(f"{n} string" for n in names))
    rest = "EANNummer Langtext Werbetext1 Bemerkung Einheit Bruttogewicht Bestand Internet Bild1 Update Zusatzfeld04 Zusatzfeld05 Zusatzfeld06 Zusatzfeld16 Zusatzfeld17 Zusatzfeld18"
    values = {"Langtext": F.lit("{\\rtf1 fein\\par weich}"), "Internet": F.lit("1"), "Bestand": F.lit("3.0"), "Bild1": F.lit("C:\\b\\x.jpg")}
    return df.withColumns({n: values.get(n, F.lit(None).cast("string")) for n in rest.split()})


def category_source(spark):
    data = [("7", "0", "Kleidung & Mehr", "0"), ("8", "7", "Hosen", "0")]
    df = spark.createDataFrame(data, "Warengruppe string, Anhang string, Bezeichnung string, Internet string")
    rest = {n: F.lit(None).cast("string") for n in ("Ebene", "Beschreibung", "Bild", "Bild_gross", "Update")}
    return df.withColumns({**rest, "ordinal": F.col("Warengruppe").cast("bigint")})


def vault_source(spark, kind):
    mime = {"image": "image/jpeg", "document": "application/pdf"}[kind]
    data = [("x.jpg", "s1", "Artikel/A1/x.jpg", "1", "A1", None), ("y.jpg", "s2", "Warengruppen/8/y.jpg", "2", None, "8")]
    df = spark.createDataFrame(data, "file_name string, checksum string, source_path string, art_type string, art_id string, cat_id string")
    return df.select("*", F.lit(mime).alias("mime"), F.lit(5).cast("bigint").alias("size"), *[F.lit("v").alias(n) for n in ("stored_file", "stored_path", "stored_at")])


def test_staging_run(spark, store):
    for name, table in STAGING_TABLES.items():
        store.write(name, create_table(spark, table))
    # surrogate ids are given outside the run; seed the category ids the articles refer to
    seeded = spark.createDataFrame([(70, 7), (80, 8)], "id bigint, source_id bigint")
    store.write("category", create_table(spark, STAGING_TABLES["category"]).unionByName(seeded, allowMissingColumns=True))
    articles = article_run_order(article_source(spark)).checkpoint()
    tree_rows = category_source(spark)
    paths = category_paths(tree_rows, "Warengruppe", "Anhang", "Bezeichnung").checkpoint()
    texts = spark.createDataFrame([("A1", " Titel ", "")], "Artikelnummer string, Meta_Title string, Meta_Description string")
    documents = spark.createDataFrame([(1, "A1", "a\\b.pdf"), (2, "A2", " ")], "Zaehler int, Artikel string, Titel string")
    sources = {
        "category": lambda: tree_rows, "article": lambda: articles, "article_texts": lambda: texts, "document": lambda: documents,
        "image_vault": lambda: vault_source(spark, "image"), "document_vault": lambda: vault_source(spark, "document"),
    }
    entities = stage_entities(NOW, article_suffix=" | shop")
    stats = rows(sync.run_entities(spark, entities, sources, store, lookups={"category_paths": paths}), "entity")
    assert {n: s["error"] for n, s in stats.items() if s["error"]} == {}
    assert len(stats) == 17
    category = rows(store.read("category"), "source_id")
    assert category[8]["seo_slug"] == "de/kleidung-und-mehr/hosen" and category[8]["id"] == 80 and category[7]["parent_id"] is None
    article = rows(store.read("article"))
    assert set(article) == {"A1", "A2", "A3"}
    assert (article["A1"]["price"], article["A1"]["tax_class_id"], article["A1"]["category"], article["A1"]["is_master"]) == (10.5, 1, 70, 1)
    assert (article["A2"]["master_model"], article["A2"]["category"], article["A3"]["price"]) == ("A1", 80, None)
    assert article["A1"]["description_html"] == "fein<br>weich" and article["A1"]["products_image"] == "x.jpg"
    assert article["A1"]["meta_title"] == "Titel" and article["A2"]["meta_description"] == "Hose Größe | shop"
    # the category table had no slugs before its own run, which came first
    assert article["A1"]["seo_slug"] == "de/kleidung-und-mehr/hose-groesse"
    assert article["A3"]["seo_slug"] == "de/kleidung-und-mehr/hose-groesse-1"
    assert {(r["id"], r["name"]) for r in store.read("attribute").collect()} == {(1, "Größe"), (2, "Farbe")}
    assert {m: r["id"] for m, r in article.items()} == {"A1": 1, "A3": 2, "A2": 3}
    links = {(r["article_id"], r["attribute_id"], r["value"]) for r in store.read("article_attribute").collect()}
    assert links == {(1, 2, "rot"), (3, 2, "blau")}
    media = store.read("media").select("hash", "class", "type", "upload", "status").collect()
    assert {tuple(m) for m in media} == {
        ("s1", "Product", "images", 1, 1), ("s2", "Category", "images", 1, 1), ("s1", "Product", "files", 1, 1), ("s2", "Category", "files", 1, 1)
    }
    relations = {(r["file_name"], r["entity_type"], r["entity_id"]) for r in store.read("media_relation").collect()}
    assert relations == {("x.jpg", "article", "A1"), ("y.jpg", "category", "8"), ("b.pdf", "article", "A1")}
    again = rows(sync.run_entities(spark, entities, sources, store, ["media_images", "file_vault_images", "media_relation_images"]), "entity")
    assert all((s["inserted"], s["updated"], s["orphans"]) == (0, 0, 0) for s in again.values())


def test_orphans_by_another_key_than_the_merge_key(spark):
    source = spark.createDataFrame([("a", "L1", "1")], SOURCE)
    target = spark.createDataFrame(
        [("a", "L1", "1", 1, 0, None), ("b", "L1", "2", 1, 0, None), ("c", "L3", "3", 1, 0, None)], TARGET
    )
    entity = spec(orphans=(OrphanPolicy(("name",), {"status": 0}),))
    found = rows(sync.classify_entity(entity, source, target))
    assert {k: (r["status"], r["action"]) for k, r in found.items()} == {"a": (1, "unchanged"), "b": (1, "kept"), "c": (0, "orphan")}


def test_two_writers_get_different_numbers(spark, store):
    store.write("t", spark.range(1))
    one, two = store._claim("t"), store._claim("t")
    assert two == one + 1
    store.write("t", spark.range(5))
    assert store.read("t").count() == 5 and store.names() == ["t"]


def test_old_snapshots_are_dropped(spark, store):
    for i in range(4):
        store.write("t", spark.range(i + 1))
    assert store.drop_old("t", keep=2) == 2 and store.read("t").count() == 4


def test_batch_run_twice(spark, store):
    """Three articles in two categories: three rows after the first and after the second run."""
    from shelfsync.functions.numbers import to_decimal
    from shelfsync.operators.lookups import resolve_fk

    source = spark.createDataFrame(
        [("ART1", "Eins", "W1", "9.99"), ("ART2", "Zwei", "W1", "19.5"), ("ART3", "Drei", "W2", "5"), ("", "ohne", "W2", "1")],
        "number string, label string, category string, price string",
    )
    store.write("category", spark.createDataFrame([(1, "W1"), (2, "W2")], "id bigint, source_id string"))
    empty = spark.createDataFrame([], "id bigint, model string, name string, category bigint, price double, note string")
    store.write("article", empty)
    entity = sync.EntitySpec(
        name="article", source="articles", target="article", keys=("model",), surrogate="id", order=("number",),
        columns={"model": F.col("number"), "name": F.col("label"), "category": F.col("category"), "price": to_decimal(F.col("price"))},
        prepare=lambda rows_, tables: resolve_fk(rows_, "category", tables["category"], "source_id", on_missing="default"),
    )
    first = sync.run_entity_batch(entity, source, store, store.tables())
    assert first == {"processed": 4, "skipped": 1, "errors": 0, "inserted": 3, "updated": 0}
    found = rows(store.read("article"))
    assert {m: (r["id"], r["category"], r["price"]) for m, r in found.items()} == {"ART1": (1, 1, 9.99), "ART2": (2, 1, 19.5), "ART3": (3, 2, 5.0)}
    second = sync.run_entity_batch(entity, source, store, store.tables())
    assert (second["inserted"], second["updated"], store.read("article").count()) == (0, 3, 3)
    assert sorted(r["id"] for r in store.read("article").collect()) == [4, 5, 6]


def test_history_looks_at_repeated_keys_only(spark):
    rows = [("a", "1", False), ("a", "2", False), ("b", "1", False), ("c", "1", False), ("c", "1.0", False), ("d", "1", False), ("d", "2", True)]
    run = spark.createDataFrame(rows, "key string, price string, __bad boolean")
    found = sync._history(run, ["key"], ["price"])
    assert [tuple(r) for r in found.collect()] == [("a", True)]
    assert "LeftSemi" in found._jdf.queryExecution().optimizedPlan().toString()

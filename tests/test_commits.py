"""Tables in buckets, transactions, blind changes, refused rows and enforced constraints."""

import random

import pytest
from pyspark.sql import functions as F

from shelfsync.operators import enforce, merge, rejects, sync
from shelfsync.operators.orphans import OrphanPolicy
from shelfsync.sources.commits import CommitConflict, TableStore
from shelfsync.sources.run_cache import RunCache

ROW = "k long, v string, n int"


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "tables"))


def content(df, *names):
    return sorted(tuple(r) for r in df.select(*(names or df.columns)).collect())


def paths(store, name):
    return {r["bucket"]: r["path"] for r in store.files(name).collect()}


def scans(df):
    """Paths that a plan reads, from its file scans."""
    return set(df.inputFiles())


# --- buckets ---


def test_only_touched_buckets_are_read_and_written(spark, store):
    stored = spark.range(20_000).select(F.col("id").alias("k"), F.lit("old").alias("v"), F.lit(1).alias("n"))
    store.create("t", stored, ["k"], 64)
    before = paths(store, "t")
    assert len(before) == 64
    # one key in a hundred, from six buckets
    chosen = store.read("t", [3, 9, 20, 31, 40, 63]).select("k").limit(200)
    changes = chosen.select("k", F.lit("new").alias("v")).union(spark.createDataFrame([(10**9, "added")], "k long, v string"))
    changes.write.parquet(store.root + "/_changes")
    spec = sync.EntitySpec(name="t", source="s", target="t", keys=("k",), columns={"k": F.col("k"), "v": F.col("v")}, delta=("v",), on_changed={"n": 2}, on_insert={"n": 3})
    source = spark.read.parquet(store.root + "/_changes")
    touched = {r[0] for r in source.select(store.state("t").bucket().alias("b")).distinct().collect()}
    assert len(touched) <= 7
    stats = sync.run_entity(spec, source, store)
    after = paths(store, "t")
    assert {b for b in after if before.get(b) != after[b]} == touched
    assert stats["updated"] == chosen.count() and stats["inserted"] == 1
    assert store.read("t").where("v = 'new'").select("n").distinct().collect() == [(2,)]
    assert store.read("t").count() == 20_001
    assert len(scans(store.read("t", touched))) == len(touched)


def test_bucketed_runs_equal_snapshot_runs(spark, store, tmp_path):
    from shelfsync.sources.snapshots import SnapshotStore

    draw = random.Random(3)
    other = SnapshotStore(spark, str(tmp_path / "other"))
    stored = spark.createDataFrame([(i, draw.choice("ab"), i) for i in range(60)], ROW)
    store.create("t", stored, ["k"], 8)
    other.write("t", stored)
    for step in range(3):
        rows = [(draw.randrange(90), draw.choice(["a", "b", None]), step * 100 + i) for i in range(25)]
        source = spark.createDataFrame(rows, "k long, v string, at int")
        for orphans in ((), (OrphanPolicy(("k",), {"n": -1}),)):
            spec = sync.EntitySpec(name="t", source="s", target="t", keys=("k",), order=("at",), columns={"k": F.col("k"), "v": F.col("v")}, delta=("v",), on_changed={"n": step}, on_insert={"n": -2}, orphans=orphans)
            assert sync.run_entity(spec, source, store) == sync.run_entity(spec, source, other)
            assert content(store.read("t").fillna("-")) == content(other.read("t").fillna("-"))


def test_ids_and_slugs_look_at_all_buckets(spark, store):
    stored = spark.createDataFrame([(i, f"s-{i}" if i else "s", i + 1) for i in range(40)], "k long, slug string, id long")
    store.create("t", stored, ["k"], 16)
    spec = sync.EntitySpec(name="t", source="s", target="t", keys=("k",), columns={"k": F.col("k"), "slug": F.lit("s")}, surrogate="id", slug="slug", ordinal="k")
    sync.run_entity(spec, spark.createDataFrame([(100,), (5,)], "k long"), store)
    assert content(store.read("t").where("k in (5, 100)")) == [(5, "s-5", 6), (100, "s-40", 41)]


def test_empty_tables_and_null_keys(spark, store):
    store.create("t", spark.createDataFrame([], ROW), ["k"], 4)
    assert store.read("t").count() == 0 and store.read("t", [1]).columns == ["k", "v", "n"]
    store.append_delta("t", spark.createDataFrame([(None, "x"), (1, "y")], "k long, v string"))
    assert content(store.read("t")) == [(1, "y", None)]
    with pytest.raises(ValueError):
        store.create("u", spark.createDataFrame([], ROW), ["k"], 4, by=["v"])


# --- blind changes ---


def test_blind_changes_are_merged_by_readers(spark, store):
    store.create("t", spark.createDataFrame([(i, "old", i) for i in range(30)] + [(None, "none", 0)], ROW), ["k"], 4)
    store.append_delta("t", spark.createDataFrame([(1, "a", 1), (1, "b", 2), (50, "c", 1)], "k long, v string, at int"), ["at"])
    store.append_delta("t", spark.createDataFrame([(1, None), (2, 7)], "k long, n int"))
    wanted = {i: ("old", i) for i in range(30)} | {1: ("b", None), 2: ("old", 7), 50: ("c", None)}
    expected = sorted([(k, *v) for k, v in wanted.items()] + [(None, "none", 0)], key=str)
    assert sorted(map(tuple, store.read("t").collect()), key=str) == expected
    assert sorted(map(tuple, store.tables()["t"].collect()), key=str) == expected
    assert store.compact("t", most=9) == 0
    n = store.compact("t")
    assert 1 <= n <= 4 and store.compact("t") == 0
    assert sorted(map(tuple, store.read("t").collect()), key=str) == expected
    assert store.state("t").deltas == {}


def test_a_blind_run_does_not_scan_the_target(spark, store):
    store.create("t", spark.createDataFrame([(i, "old", i) for i in range(30)], ROW), ["k"], 4)
    spec = sync.EntitySpec(name="t", source="s", target="t", keys=("k",), columns={"k": F.col("a"), "v": F.col("b")})
    assert not sync.needs_existing(spec)
    read = []
    kept = store._rows
    store._rows = lambda paths, kinds: read.append([]) or kept(paths, kinds).limit(0)  # whatever is read of it has no rows
    stats = sync.run_entity(spec, spark.createDataFrame([(1, "x"), (77, "y"), (None, "z")], "a long, b string"), store)
    assert stats == {"processed": 3, "skipped": 1, "errors": 0, "inserted": None, "updated": None, "unchanged": None, "orphans": 0}
    store._rows = kept
    assert content(store.read("t").where("k in (1, 77)")) == [(1, "x", 1), (77, "y", None)]
    for _ in range(sync.MOST_DELTAS + 1):
        sync.run_entity(spec, spark.createDataFrame([(1, "again")], "a long, b string"), store)
    assert len(store.state("t").deltas) <= sync.MOST_DELTAS + 1 and store.read("t").where("v = 'again'").count() == 1


# --- transactions ---


def pair(broken=False):
    first = sync.EntitySpec(name="a", source="s", target="a", keys=("k",), columns={"k": F.col("k"), "v": F.upper("v")}, delta=("v",), order=("at desc",))
    prepare = (lambda rows, tables: rows.select("nowhere")) if broken else None
    second = sync.EntitySpec(name="b", source="s", target="b", keys=("v",), columns={"v": F.col("v"), "n": F.col("at")}, order=("at",), prepare=prepare)
    return [first, second]


def test_targets_of_one_source_are_committed_together(spark, store, tmp_path):
    store.write("a", spark.createDataFrame([(1, "X", 1)], ROW))
    store.write("b", spark.createDataFrame([], "v string, n int"))
    spark.createDataFrame([(1, "x", 1), (2, "y", 2), (2, "z", 3), (3, "y", 4)], "k long, v string, at int").write.parquet(str(tmp_path / "s"))
    source = spark.read.parquet(str(tmp_path / "s"))
    number = store.current()[0]
    with pytest.raises(Exception):
        sync.run_targets(pair(broken=True), source, store)
    assert store.current()[0] == number and store.read("a").count() == 1
    stats = sync.run_targets(pair(), source, store)
    assert store.current()[0] == number + 1
    assert (stats["a"]["unchanged"], stats["a"]["inserted"], stats["b"]["inserted"]) == (1, 2, 3)
    assert content(store.read("a"), "k", "v") == [(1, "X"), (2, "Y"), (3, "Y")] and content(store.read("b")) == [("x", 1), ("y", 4), ("z", 3)]


def test_of_two_writers_of_a_table_one_fails(spark, store):
    store.write("a", spark.range(1))
    store.write("b", spark.range(1))
    one, two, three = store.begin(), store.begin(), store.begin()
    one.write("a", spark.range(2))
    two.write("a", spark.range(3))
    three.write("b", spark.range(4))
    one.commit()
    three.commit()
    with pytest.raises(CommitConflict):
        two.commit()
    assert (store.read("a").count(), store.read("b").count()) == (2, 4)


def test_a_commit_cut_short_does_not_count(spark, store):
    store.write("a", spark.range(3))
    number = store.current()[0]
    with open(f"{store.root}/_commits/{number + 1:08d}.json", "w") as out:
        out.write('{"a": {"schema"')
    assert store.read("a").count() == 3
    store.write("a", spark.range(5))
    assert store.read("a").count() == 5 and store.current()[0] == number + 2


def test_old_files_are_dropped(spark, store):
    store.create("t", spark.createDataFrame([(i, "old", i) for i in range(30)], ROW), ["k"], 4)
    store.write("u", spark.range(3))
    for i in range(3):
        store.append_delta("t", spark.createDataFrame([(i, "x")], "k long, v string"))
    store.compact("t")
    assert store.drop_old(keep=1) >= 4
    assert store.read("t").where("v = 'x'").count() == 3 and store.read("u").count() == 3


# --- one scan ---


def test_a_run_scans_its_source_once(spark, store, tmp_path):
    opened = spark.sparkContext.accumulator(0)

    def counted(batches):
        opened.add(1)
        yield from batches

    store.write("t", spark.createDataFrame([(1, "x", 1)], ROW))
    spark.createDataFrame([(1, "x"), (2, "y"), (2, "z")], "k long, v string").coalesce(1).write.parquet(str(tmp_path / "s"))
    source = spark.read.parquet(str(tmp_path / "s")).mapInArrow(counted, "k long, v string")
    spec = sync.EntitySpec(name="t", source="s", target="t", keys=("k",), columns={"k": F.col("k"), "v": F.col("v")}, delta=("v",),
                           on_changed={"n": 5}, surrogate=None, orphans=(OrphanPolicy(("k",), {"n": 0}), OrphanPolicy(("v",), {"n": 0})))
    sync.run_entity(spec, source, store)
    assert opened.value == 1
    entities = [spec, sync.EntitySpec(name="u", source="s", target="t", keys=("k",), columns={"k": F.col("k"), "v": F.lit("w")})]
    stats = sync.run_entities(spark, entities, {"s": lambda: source}, store).collect()
    assert opened.value == 2 and [s["error"] for s in stats] == [None, None]


def test_kept_frames_are_released(spark, tmp_path):
    with RunCache(spark, str(tmp_path)) as kept:
        df = kept.keep(spark.range(3).withColumn("none", F.lit(None)), "x")
        assert kept.keep(spark.range(9), "x") is df and df.count() == 3
    assert list(tmp_path.iterdir()) == []


# --- refused rows ---


def test_no_value_is_overwritten_by_a_failed_cast(spark):
    target = spark.createDataFrame([("a", 5, 1.0), ("b", 6, 2.0)], "k string, n int, x double")
    changes = spark.createDataFrame([("a", "x9", "3"), ("b", "7", None), ("c", "-", "y")], "k string, n string, x string")
    for small in (False, True):
        assert content(merge.upsert(target, changes, ["k"], small_changes=small).fillna(-1)) == [("a", 5, 1.0), ("b", 7, -1.0)]
    assert content(merge.replace_merge(target, changes, ["k"]).fillna(-1)) == [("a", 5, 1.0), ("b", 7, -1.0)]
    found = content(rejects.rejects(changes, target, ["k"], "t"))
    assert found == [
        ("t", '{"k":"a"}', "n", "x9", "not a int"), ("t", '{"k":"c"}', "n", "-", "not a int"), ("t", '{"k":"c"}', "x", "y", "not a double"),
    ]


def test_refused_values_are_kept_beside_the_table(spark, store):
    store.write("t", spark.createDataFrame([(1, "a", 1)], ROW))
    spec = sync.EntitySpec(name="t", source="s", target="t", keys=("k",), columns={"k": F.col("k"), "n": F.col("n")}, delta=("n",))
    source = spark.createDataFrame([("1", "x"), ("2", "3"), ("no", "4")], "k string, n string")
    stats = sync.run_entity(spec, source, store)
    assert (stats["errors"], stats["inserted"]) == (2, 1)
    assert content(store.read("t__rejects"), "column", "value") == [("k", "no"), ("n", "x")]
    sync.run_entity(spec, spark.createDataFrame([("1", "2")], "k string, n string"), store)
    assert store.read("t__rejects").count() == 0
    batch = sync.run_entity_batch(spec, source, store)
    assert (batch["errors"], batch["inserted"], batch["updated"]) == (2, 0, 1)
    assert content(store.read("t").select("k", "n")) == [(1, 2), (2, 3)] and store.read("t__rejects").count() == 2


def test_an_error_is_no_orphan_by_another_key(spark, store):
    store.write("t", spark.createDataFrame([(1, "a", 1), (2, "b", 2)], ROW))
    spec = sync.EntitySpec(name="t", source="s", target="t", keys=("k",), columns={"k": F.col("k"), "v": F.col("v"), "n": F.col("n")}, orphans=(OrphanPolicy(("v",), {"n": 0}),))
    stats = sync.run_entity(spec, spark.createDataFrame([(1, "c", "x"), (3, "d", "4")], "k long, v string, n string"), store)
    assert (stats["errors"], stats["orphans"]) == (1, 1) and content(store.read("t")) == [(1, "a", 1), (2, "b", 0), (3, "d", 4)]


# --- statistics ---


@pytest.mark.parametrize("seed", [1, 2])
def test_counts_by_source_row(spark, store, seed):
    draw = random.Random(seed)
    stored = {i: draw.choice("ab") for i in range(10)}
    rows = [(draw.choice([0, 0, 0, 3, 5, 12, 13, None]), draw.choice("ab"), draw.choice(["1", "2", "x"]), i) for i in range(120)]
    store.write("t", spark.createDataFrame([(k, v, 1) for k, v in stored.items()], ROW))
    spec = sync.EntitySpec(name="t", source="s", target="t", keys=("k",), columns={"k": F.col("k"), "v": F.col("v"), "n": F.col("n")}, delta=("v",), order=("at",))
    stats = sync.run_entity(spec, spark.createDataFrame(rows, "k long, v string, n string, at int").repartition(7), store)
    wanted = dict.fromkeys(("processed", "skipped", "errors", "inserted", "updated", "unchanged", "orphans"), 0)
    for k, v, n, _ in rows:
        wanted["processed"] += 1
        if k is None:
            wanted["skipped"] += 1
        elif n == "x":
            wanted["errors"] += 1
        else:
            wanted["inserted" if k not in stored else "updated" if stored[k] != v else "unchanged"] += 1
            stored[k] = v
    assert stats == wanted
    assert sum(stats[n] for n in ("skipped", "errors", "inserted", "updated", "unchanged")) == stats["processed"]


def test_a_new_key_given_twice_is_inserted_once(spark, store):
    store.write("t", spark.createDataFrame([], ROW))
    spec = sync.EntitySpec(name="t", source="s", target="t", keys=("k",), columns={"k": F.col("k"), "v": F.col("v")}, delta=("v",))
    stats = sync.run_entity(spec, spark.createDataFrame([(1, "n"), (1, "n")], "k long, v string"), store)
    assert (stats["inserted"], stats["updated"], stats["unchanged"]) == (1, 0, 1)


# --- constraints ---


def rules():
    return enforce.Constraints(
        checks={"filled": F.col("v").isNotNull(), "small": F.col("n") < 10},
        unique={"one v": ["v"]}, references={"known": ("k", "parent", "id")},
    )


def test_a_broken_constraint_withholds_the_commit(spark, store):
    store.write("parent", spark.range(5).toDF("id"))
    good = spark.createDataFrame([(1, "a", 1), (2, "b", None), (None, "c", 3)], ROW)
    assert enforce.enforced_write(store, "t", good, rules()) == {}
    bad = spark.createDataFrame([(1, "a", 1), (9, "a", 11), (2, None, 2), (2, "a", 1)], ROW)
    with pytest.raises(enforce.ConstraintViolation) as found:
        enforce.enforced_write(store, "t", bad, rules())
    assert found.value.violations == {"filled": 1, "small": 1, "one v": 2, "known": 1}
    assert content(store.read("t"), "v") == [("a",), ("b",), ("c",)]


def test_rows_that_break_a_rule_are_set_aside(spark, store):
    store.write("parent", spark.range(5).toDF("id"))
    rows = spark.createDataFrame([(1, "a", 11), (2, "a", 2), (3, "a", 1), (9, "d", 1), (2, None, 20), (None, "e", None)], ROW)
    counts = enforce.enforced_write(store, "t", rows, rules(), ["n"], enforce.QUARANTINE)
    assert counts == {"filled": 1, "small": 2, "one v": 1, "known": 1}
    assert sorted(map(tuple, store.read("t").collect()), key=str) == sorted([(3, "a", 1), (None, "e", None)], key=str)
    refused = {tuple(r[:3]): list(r[3]) for r in store.read("t__refused").collect()}
    assert refused == {(1, "a", 11): ["small"], (2, "a", 2): ["one v"], (9, "d", 1): ["known"], (2, None, 20): ["filled", "small"]}
    empty = enforce.enforced_write(store, "t", rows.limit(0), rules(), mode=enforce.QUARANTINE)
    assert empty == {} and store.read("t").count() == 0


def test_declared_tables_imply_constraints(spark):
    from shelfsync.operators.schema import Field, TargetTable

    table = TargetTable("t", {"k": Field("int", required=True), "v": Field()}, business_key=["k"])
    implied = enforce.Constraints.of(table)
    assert implied.names() == ["t.k required", "t unique k"]


# --- listing ---


def test_listing_in_tasks(spark, tmp_path):
    import os

    from shelfsync.sources.files import FolderTable, list_folders, scan_folder_table

    base = tmp_path / "records"
    base.mkdir()
    for i in range(20_000):
        os.mkdir(base / f"r{i}")
    os.mkdir(base / ".hidden")
    (base / "file.txt").write_text("x")
    (base / "r7" / "a.txt").write_text("seven\r\n")
    (base / "r8" / "deep").mkdir()
    found = scan_folder_table(spark, str(tmp_path), FolderTable("records", ["key"], ["a"]))
    assert found.count() == 20_000 and found.where("a IS NOT NULL").collect() == [("r7", "seven")]
    two = list_folders(spark, str(tmp_path), depth=3).groupBy("level").count().collect()
    assert dict(map(tuple, two)) == {1: 1, 2: 20_001, 3: 1}


def test_errors_of_functions_are_counted(spark):
    from shelfsync.functions import registry

    df = spark.createDataFrame([("1",), ("0",), (None,), ("x",), ("0",)], "v string")
    step = registry.guarded(lambda v: str(10 // int(v)), "tenth")
    assert [r[0] for r in df.select(step(F.col("v"))).collect()] == ["10", "0", None, "x", "0"]
    found = {r["message"].split(":")[0]: (r["function"], r["times"], r["example"]) for r in registry.error_log(df, [(step, F.col("v"))]).collect()}
    assert found == {"ZeroDivisionError": ("tenth", 2, "0"), "ValueError": ("tenth", 1, "x")}


def test_steps_of_rare_and_hot_keys(spark):
    import random

    from shelfsync.operators.ordering import neighbour_steps

    dice = random.Random(5)
    rows = [(f"k{min(dice.randrange(30), 12)}", i, dice.randrange(3)) for i in range(600)]
    expected = {}
    for key, _, value in sorted(rows, key=lambda r: r[1]):
        taken, moved, head, last = expected.get(key, (0, 0, value, value))
        expected[key] = (taken + 1, moved + (value != last), head, value)
    dice.shuffle(rows)
    df = spark.createDataFrame(rows, "key string, at int, value int")
    changed = lambda a, b: F.expr(f"{a}.value <> {b}.value")
    for hot in (0, 25, 1000):
        steps = neighbour_steps(df, ["key"], ["at"], ["value"], changed, hot_rows=hot)
        assert {r["key"]: (r["taken"], r["moved"], r["head"]["value"]) for r in steps.collect()} == {k: v[:3] for k, v in expected.items()}
    plain = neighbour_steps(df, ["key"], ["at"], ["value"], changed)
    assert "rangepartitioning" not in plain._jdf.queryExecution().toString() and "Join" not in plain._jdf.queryExecution().toString()


def test_large_buckets_are_written_by_several_tasks(spark, tmp_path):
    from shelfsync.sources.commits import TableStore

    store = TableStore(spark, str(tmp_path))
    df = spark.range(40_000).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v")).repartition(8)
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    try:
        store.create("t", df, ["k"], 2)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", size)
    found = store.files("t").groupBy("bucket").agg(F.count("*").alias("files"), F.sum("rows").alias("rows")).collect()
    assert len(found) == 2 and all(r["files"] > 2 for r in found) and sum(r["rows"] for r in found) == 40_000
    assert store.read("t").exceptAll(df).isEmpty() and store.read("t", [1]).count() == max(r["rows"] for r in found if r["bucket"] == 1)

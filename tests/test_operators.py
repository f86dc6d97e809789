"""Merges, filters, ordering, schema, tree, sources and the upload queue."""

import pytest
from pyspark.sql import Window, functions as F

from shelfsync.operators import filters, inventory, merge, ordering, run_log, schema, sync, tree, work_queue
from shelfsync.sources import files, logs, tables


def pairs(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_keeps_unmentioned_columns(spark):
    target = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, v string, w string")
    changes = spark.createDataFrame([(2, None), (3, "n")], "k int, v string")
    for small in (False, True):
        merged = merge.upsert(target, changes, ["k"], small_changes=small)
        assert sorted((tuple(r) for r in merged.collect()), key=lambda r: r[0]) == [(1, "a", "x"), (2, None, "y"), (3, "n", None)]
    only_keys = merge.upsert(target, spark.createDataFrame([(2,), (9,)], "k int"), ["k"])
    assert {tuple(r) for r in only_keys.collect()} == {(1, "a", "x"), (2, "b", "y"), (9, None, None)}
    with pytest.raises(ValueError):
        merge.upsert(target, changes, [])
    with pytest.raises(ValueError):
        merge.upsert(target, changes.withColumn("z", F.lit(1)), ["k"])


def test_small_changes_do_not_shuffle_the_target(spark, tmp_path):
    path = str(tmp_path / "changes")
    spark.createDataFrame([(5, "b")], "k bigint, v string").write.parquet(path)
    target = spark.range(1000).select(F.col("id").alias("k"), F.lit("a").alias("v"))
    merged = merge.upsert(target, spark.read.parquet(path), ["k"], small_changes=True)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    assert merged.where("v = 'b'").count() == 1 and merged.count() == 1000


def test_replace_merge_last_row_wins(spark):
    target = spark.createDataFrame([(1, "a", "old"), (2, "b", "old")], "id bigint, k string, v string")
    staged = spark.createDataFrame([("a", "1", 1), ("a", "2", 2), ("c", "3", 3)], "k string, v string, at int")
    merged = merge.replace_merge(target.withColumn("at", F.lit(0)), staged, ["k"], ["at"], "id", 2)
    assert {(r["id"], r["k"], r["v"]) for r in merged.collect()} == {(2, "b", "old"), (3, "a", "2"), (4, "c", "3")}
    assert merge.replace_merge(target, staged.select("k", "v"), []).count() == 5


def test_filters_refuse_bad_rules(spark):
    df = spark.createDataFrame([(1,), (None,)], "x int")
    with pytest.raises(ValueError):
        filters.apply_filters(df, {"x": {"about": 1}})
    with pytest.raises(ValueError):
        filters.apply_filters(df, {"x": {"between": [1]}})
    assert filters.apply_filters(df, {"x": {"in": []}}).count() == 0
    assert filters.apply_filters(df, {"x": {"not_in": []}}).count() == 2
    assert filters.apply_filters(df, {}).count() == 2


def test_filter_and_columns_reach_the_scan(spark):
    spec = tables.SourceTable("lineitem.parquet", ["l_orderkey"], {"l_quantity": {"gt": 40}})
    plan = tables.scan_table(spark, spec, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(l_quantity,40.0)" in plan and "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan


@pytest.mark.parametrize("block,levels", [(4, 2), (4, 1), (1 << 20, 0)])
def test_running_sum_of_a_hot_group(spark, block, levels):
    rows = spark.range(500).select(
        F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 7).alias("g"), (F.col("id") * 3).alias("p"), (F.col("id") % 5).alias("v")
    )
    whole = Window.partitionBy("g").orderBy("p")
    expected = pairs(rows.withColumn("s", F.sum("v").over(whole)))
    assert pairs(ordering.running_sum(rows, ["g"], "p", F.col("v"), "s", block, levels).select("g", "p", "v", "s")) == expected


def test_block_levels():
    assert [ordering.block_levels(n, 10) for n in (None, 9, 10, 99, 100, 10**9)] == [0, 0, 1, 1, 2, 2]


def test_numbers_are_dense_over_partitions(spark):
    rows = spark.range(1000).select((F.col("id") % 10).alias("a"), (F.lit(1000) - F.col("id")).alias("b")).repartition(7)
    numbered = ordering.global_number(rows, ["a desc", "b"], "n", 5).collect()
    by_number = [(r["a"], r["b"]) for r in sorted(numbered, key=lambda r: r["n"])]
    assert by_number == sorted(by_number, key=lambda r: (-r[0], r[1]))
    assert sorted(r["n"] for r in numbered) == list(range(5, 1005))


def test_keep_latest_cuts_before_the_shuffle(spark):
    rows = spark.range(2000).select((F.col("id") % 2).alias("job"), "id")
    plan = ordering.keep_latest(rows, ["job"], ["id desc"], 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    spread = ordering.keep_latest(rows, ["job"], ["id desc"], 3, spread=["id"])
    assert pairs(spread.select("job", "id")) == [(0, 1994), (0, 1996), (0, 1998), (1, 1995), (1, 1997), (1, 1999)]


def test_natural_sort(spark):
    names = ["img12", "IMG2", "img1", "a10b2", "a10b10", "a9", "img002x", "b"]
    rows = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r["n"] for r in rows.orderBy(ordering.natural_key(F.col("n")), "n").collect()]
    assert got == ["a9", "a10b2", "a10b10", "b", "img1", "IMG2", "img002x", "img12"]


def test_key_resolution_order():
    table = lambda **k: schema.TargetTable("t", ["a"], **k).merge_keys()
    assert table(explicit_unique=["e"], business_key=["b"]) == ["e"]
    assert table(unique_key=["u"], keys=["k"]) == ["u"]
    assert table(keys=["k"], business_key=["b"]) == ["k"]
    assert table(business_key=["b"], unique_constraint=["c"], primary_key=["p"]) == ["b"]
    assert table(unique_constraint=["c"], primary_key=["p"]) == ["c"]
    assert table(legacy_keys=["l"], primary_key=["p"]) == ["l"]
    assert table(primary_key=["p", "p"]) == ["p"]
    assert table() == []


def test_constraints(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (None, "b"), (None, "c")], "k int, f string")
    assert pairs(schema.check_unique(df, ["k"])) == [(1, 2)]
    checks = {"flag": schema.one_of("f", "a"), "there": schema.required("f")}
    assert dict(schema.check_constraints(df, checks).collect()) == {"flag": 2, "there": 1}


def test_tree_with_cycle_blank_and_missing_parent(spark):
    rows = [("1", "0", "A"), ("2", "1", ""), ("3", "2", "C"), ("4", "9", "D"), ("5", "6", "E"), ("6", "5", "F"), ("7", "6", "G"), ("8", "", ""), ("9x", "8", "H")]
    found = {r["id"]: r["path"] for r in tree.category_paths(spark.createDataFrame(rows, "id string, parent string, name string")).collect()}
    assert found == {"1": "a", "2": "a/", "3": "a//c", "4": "d", "5": None, "6": None, "7": None, "8": "", "9x": "h"}


def test_deep_tree(spark):
    rows = [(str(i), str(i - 1), f"n{i}") for i in range(1, 40)]
    found = {r["id"]: r for r in tree.category_paths(spark.createDataFrame(rows, "id string, parent string, name string")).collect()}
    assert found["39"]["path"] == "/".join(f"n{i}" for i in range(1, 40)) and found["39"]["depth"] == 39


def test_folder_table(spark, tmp_path):
    def put(folder, **texts):
        path = tmp_path / "Artikel" / folder
        path.mkdir(parents=True)
        for name, text in texts.items():
            (path / f"{name}.txt").write_bytes(text)

    put("A 1__de", Meta_Title=b"eins\r\n\n", Other="ä".encode())
    put("A2__en")
    put("A3", Meta_Title=b"wrong parts")
    put(".hidden__x", Meta_Title=b"no")
    spec = files.FolderTable("Artikel", ["no", "lang"], ["Meta_Title", "Other"])
    assert set(map(tuple, files.scan_folder_table(spark, str(tmp_path), spec).collect())) == {("A 1", "de", "eins", "ä"), ("A2", "en", None, None)}
    assert files.scan_folder_table(spark, str(tmp_path), spec, empty_folders=False).count() == 1
    wide = files.scan_folder_table_dynamic(spark, str(tmp_path), files.FolderTable("Artikel", ["no"]))
    assert set(wide.columns) == {"no", "Meta_Title", "Other"}
    odd = files.FolderTable("x", ["k"], filename_case="lower", sanitize=True)
    assert odd.field_file("Größe 1") == "gr__e_1.txt"
    with pytest.raises(ValueError):
        files.scan_folder_table(spark, str(tmp_path), files.FolderTable("Artikel", []))


def test_folder_table_charset(spark, tmp_path):
    path = tmp_path / "T" / "k"
    path.mkdir(parents=True)
    (path / "F.txt").write_bytes("Größe".encode("latin-1"))
    spec = files.FolderTable("T", ["id"], ["F"], encoding="iso-8859-1")
    assert files.scan_folder_table(spark, str(tmp_path), spec).first()["F"] == "Größe"


def test_inventory_copy_and_second_run(spark, tmp_path):
    source, vault = tmp_path / "in", tmp_path / "vault"
    (source / "sub").mkdir(parents=True)
    (source / "a b.JPG").write_bytes(b"12345")
    (source / "sub" / "c.tar.gz").write_bytes(b"123")
    (source / "no.txt").write_bytes(b"1")
    found = {r["relative_path"]: r for r in files.scan_files(spark, str(source), ["jpg", "gz"]).collect()}
    assert set(found) == {"a b.JPG", "sub/c.tar.gz"}
    one = found["a b.JPG"]
    assert (one["ext"], one["name_stem"], one["size"], one["mime"], one["dir"]) == ("jpg", "a b", 5, "image/jpeg", str(source))
    assert files.scan_files(spark, str(source), recursive=False).count() == 2
    listing = files.scan_files(spark, str(source), ["jpg", "gz"])
    table = schema.create_table(spark, schema.TargetTable("vault", {n: schema.Field("integer") if n in ("size", "change") else schema.Field() for n in inventory.VAULT_COLUMNS}))
    first = sync.classify_entity(inventory.file_entity("vault", "now"), listing, table).cache()
    nothing = spark.createDataFrame([], "target string")
    plan = inventory.vault_copy_plan(first, str(vault), nothing)
    assert [r["error"] for r in work_queue.execute_plan(plan).collect()] == [None, None]
    assert (vault / "a_b.JPG").read_bytes() == b"12345" and (vault / "c.tar.gz").exists()
    again = sync.classify_entity(inventory.file_entity("vault", "later"), listing, first.drop("action"))
    assert {r["action"] for r in again.collect()} == {"unchanged"}
    present = files.scan_files(spark, str(vault)).select("path")
    assert inventory.vault_copy_plan(again, str(vault), present).count() == 0
    assert inventory.vault_copy_plan(again, str(vault), present.limit(0)).count() == 2
    bad = spark.createDataFrame([(str(source / "gone"), str(vault / "x"))], "source string, target string")
    assert work_queue.execute_plan(bad).first()["error"]
    assert sorted(p.name for p in vault.iterdir()) == ["a_b.JPG", "c.tar.gz"]


def test_upload_queue(spark):
    media = spark.createDataFrame(
        [(1, "a.jpg", "", "", "h", "image", 1), (2, "b.jpg", "s.jpg", "/sub/", "h", "image", 1), (3, "c.pdf", None, None, "h", "document", 1), (4, "d.jpg", "", "", "h", "image", 0)],
        "media_id int, file_name string, stored_file string, stored_path string, hash string, kind string, upload int",
    )
    spec = work_queue.QueueSpec(kind_value="image")
    waiting = work_queue.pending(media, spec)
    assert [(r["id"], r["stored_file"]) for r in waiting.collect()] == [(1, "a.jpg"), (2, "s.jpg")]
    inventory_rows = spark.createDataFrame([("a.jpg", 10), ("sub/s.jpg", 900)], "relative_path string, size int")
    outcomes = work_queue.classify_transfer(waiting, inventory_rows, max_size=500)
    assert {r["id"]: r["outcome"] for r in outcomes.collect()} == {1: "copied", 2: "too_large"}
    done = outcomes.where("outcome = 'copied'").select("id")
    assert [r["id"] for r in work_queue.pending(work_queue.mark_done(media, done, spec), spec).collect()] == [2]
    off = work_queue.classify_transfer(waiting, inventory_rows, enabled=False)
    assert work_queue.queue_summary(off).first().asDict() == {"total": 2, "transferred": 0, "failed": 0, "skipped": 2, "bytes": 0}
    assert work_queue.QueueSpec(flag="uploaded").pending_value == 0 and work_queue.QueueSpec(flag="uploaded").cleared_value == 1


def test_run_log(spark, tmp_path):
    rows = [(f"2024-01-0{d}T00:00:0{i}+00:00", "op", level, f"m{i}", "1") for d in (1, 2) for i, level in enumerate(["info", "Error", "warning", "odd"])]
    log = spark.createDataFrame(rows, "timestamp string, operation string, level string, message string, mapping_version string")
    root = str(tmp_path / "log")
    logs.write_run_log(log.withColumn("context", F.create_map(F.lit("a"), F.lit("1"))), root, "warning")
    part = next((tmp_path / "log" / "day=2024-01-02").glob("*.json"))
    (tmp_path / "log" / "day=2024-01-02" / "broken.json").write_text("{not json\n" + part.read_text().splitlines()[0] + "\n")
    day = logs.read_run_log(spark, root, "2024-01-02")
    assert {r["message"] for r in day.collect()} == {"m1", "m2"} and day.count() == 3
    assert [r["message"] for r in logs.read_run_log(spark, root, "2024-01-02", 1).collect()] == ["m2"]
    assert logs.read_run_log(spark, root, "2024-01-03").count() == 0


def test_status_of_idle_job(spark):
    jobs = spark.createDataFrame([("a",), ("b",)], "job string")
    events = spark.createDataFrame(
        [("a", "t1", 1, "running", "s", "m", 0, 9, True), ("a", "t2", 2, "ready", None, "done", 9, 9, False), ("a", "t3", 3, "running", "s", "m", 1, 9, True)],
        "job string, ts string, seq int, state string, stage string, message string, processed int, total int, began boolean",
    )
    status = {r["job"]: r for r in run_log.job_status(events, jobs).collect()}
    assert (status["a"]["state"], status["a"]["started_at"], status["a"]["finished_at"]) == ("running", "t3", None)
    assert (status["b"]["state"], status["b"]["processed"]) == ("idle", 0)


def test_jdbc_options():
    options = tables.jdbc_options("mysql", "shop", "db", 3306, user="u", partitionColumn="id", numPartitions=8)
    assert options["url"] == "jdbc:mysql://db:3306/shop" and options["numPartitions"] == "8"


def test_pages_from_start_end_and_middle(spark):
    rows = spark.range(100).select((F.col("id") % 10).alias("a"), "id").repartition(5)
    order = ["a desc", "id"]
    whole = [tuple(r) for r in rows.orderBy(F.desc("a"), "id").collect()]
    for number, expected in ((1, whole[:7]), (8, whole[49:56]), (15, whole[98:]), (99, whole[98:])):
        for reach in (1 << 20, 10):
            assert [tuple(r) for r in ordering.page(rows, order, number, 7, reach).collect()] == expected
    numbered = ordering.page_by_row_number(rows, order, 20, 5, reach=10)
    assert sorted((r["row_no"], r["id"]) for r in numbered.collect()) == [(i + 1, whole[i][1]) for i in range(20, 25)]


def test_blank_keys_are_spread_and_find_nothing(spark):
    from shelfsync.operators import lookups

    rows = spark.createDataFrame([(i, " " if i % 3 else None, "k1 ") for i in range(60)], "i int, blank string, key string")
    dim = spark.createDataFrame([("k1", 7), ("k1", 9), ("", 8), (None, 8)], "code string, id int")
    assert {r["blank"] for r in lookups.resolve_fk(rows, "blank", dim, "code").collect()} == {None}
    assert [r["key"] for r in lookups.resolve_fk(rows, "key", dim, "code").collect()] == [7] * 60
    spread = rows.select(lookups.spread_blanks(rows, lookups.lookup_key(F.col("blank"))).alias("k")).distinct().count()
    assert spread > 30


def _folders(tmp_path, n):
    for i in range(n):
        path = tmp_path / "T" / f"k{i}"
        path.mkdir(parents=True)
        if i % 10:
            (path / "F.txt").write_bytes(f"text {i}\r\n".encode() * (1 + i % 2))
    (tmp_path / "T" / "k1" / "below").mkdir()
    (tmp_path / "T" / "k1" / "below" / "F.txt").write_text("not a field")
    (tmp_path / "T" / "k1" / "F.md").write_text("before .txt")
    (tmp_path / "T" / "k2" / "_F.txt").write_text("hidden")


def _text_of(i):
    return None if i % 10 == 0 else "\r\n".join([f"text {i}"] * (1 + i % 2))


def _driver_lists_nothing(rows, spark):
    return not rows.inputFiles() and rows.rdd.getNumPartitions() <= int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_folder_table_is_read_by_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "BATCH_BYTES", 500)
    _folders(tmp_path, 400)
    rows = files.scan_folder_table(spark, str(tmp_path), files.FolderTable("T", ["id"], ["F", "G"]))
    assert {tuple(r) for r in rows.collect()} == {(f"k{i}", _text_of(i), None) for i in range(400)} and rows.count() == 400
    assert _driver_lists_nothing(rows, spark)
    filled = files.scan_folder_table(spark, f"file://{tmp_path}", files.FolderTable("T", ["id"], ["F"]), empty_folders=False)
    assert {r["id"] for r in filled.collect()} == {f"k{i}" for i in range(400) if i % 10}


def test_folder_table_through_sparks_reader(spark, tmp_path, monkeypatch):
    _folders(tmp_path, 30)
    spec = files.FolderTable("T", ["id"], ["F"])
    own = [set(map(tuple, files.scan_folder_table(spark, str(tmp_path), spec, empty).collect())) for empty in (True, False)]
    monkeypatch.setattr(files, "_task_readable", lambda base: False)
    theirs = [set(map(tuple, files.scan_folder_table(spark, str(tmp_path), spec, empty).collect())) for empty in (True, False)]
    assert own == theirs


def test_dynamic_folder_table_is_read_by_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "BATCH_BYTES", 500)
    _folders(tmp_path, 400)
    rows = files.scan_folder_table_dynamic(spark, str(tmp_path), files.FolderTable("T", ["id"]))
    assert rows.columns == ["id", "F"] and {tuple(r) for r in rows.collect()} == {(f"k{i}", _text_of(i)) for i in range(400)}
    assert _driver_lists_nothing(rows, spark)
    named = files.scan_folder_table_dynamic(spark, str(tmp_path), files.FolderTable("T", ["id"]), names=["F", "none"], empty_folders=False)
    assert named.count() == 360 and named.where("none IS NOT NULL").isEmpty()


def test_dynamic_folder_table_lists_folders_once(spark, tmp_path):
    _folders(tmp_path, 20)
    rows = files.scan_folder_table_dynamic(spark, str(tmp_path), files.FolderTable("T", ["id"]))
    before = {tuple(r) for r in rows.collect()}
    (tmp_path / "T" / "later").mkdir()
    (tmp_path / "T" / "k0" / "G.txt").write_bytes(b"later")
    assert {tuple(r) for r in rows.collect()} == before and len(before) == 20

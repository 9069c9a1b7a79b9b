from __future__ import annotations

from pyspark.sql import functions as F

from carryall.operators import movement
from carryall.plans.movement_queries import make_table
from carryall.sources import partitions
from carryall.sources.appends import append_rows
from carryall.sources.tables import (
    commit_rows,
    fresh_name,
    fresh_path,
    get_property,
    partition_columns,
    set_properties,
    shared_folder,
)

AT = "2024-03-01 12:00:00"
MIXED = "id int, v string, m map<string,int>, p string, q int"


def mixed(spark, *rows):
    return spark.createDataFrame(list(rows), MIXED)


def test_null_and_moved_values_change_the_fingerprint(spark, rows):
    src = spark.createDataFrame([("p", "a", None), ("q", "a", "a"), ("r", "x", "y")], "k string, a string, b string")
    dst = spark.createDataFrame([("p", None, "a"), ("q", "a", "a"), ("r", "y", "x")], "k string, a string, b string")
    found = movement.changed_partitions(src, dst, ["k"])
    assert rows(found, "k", "kind") == [("p", "changed"), ("r", "changed")]


def test_copies_count_and_order_does_not(spark, rows):
    src = spark.createDataFrame([("p", 1), ("p", 1), ("p", 2)], "k string, a int")
    same = spark.createDataFrame([("p", 2), ("p", 1), ("p", 1)], "k string, a int")
    other = spark.createDataFrame([("p", 2), ("p", 2), ("p", 1)], "k string, a int")
    assert movement.changed_partitions(src, same, ["k"]).count() == 0
    assert rows(movement.changed_partitions(src, other, ["k"]), "kind", "n_src", "n_dst") == [("changed", 3, 3)]
    assert rows(movement.content_difference(src, other)) == [("p", 1, 2, 1), ("p", 2, 1, 2)]


def test_maps_are_compared_by_content(spark, rows):
    typ = "k string, m map<string,map<string,int>>, a array<map<string,int>>, s struct<x:map<string,int>>"
    src = spark.createDataFrame(
        [("p", {"a": {"x": 1, "y": 2}, "b": None}, [{"u": 1, "w": 2}, None], ({"c": 1, "d": 2},)), ("q", {}, [], None)], typ
    )
    same = spark.createDataFrame(
        [("p", {"b": None, "a": {"y": 2, "x": 1}}, [{"w": 2, "u": 1}, None], ({"d": 2, "c": 1},)), ("q", {}, [], None)], typ
    )
    assert movement.changed_partitions(src, same, ["k"]).count() == 0
    assert movement.content_difference(src, same).count() == 0
    for other in (
        [("p", {"a": {"x": 1, "y": 3}, "b": None}, [{"u": 1, "w": 2}, None], ({"c": 1, "d": 2},)), ("q", {}, [], None)],
        [("p", {"a": {"x": 1, "y": 2}, "b": None}, [None, {"u": 1, "w": 2}], ({"c": 1, "d": 2},)), ("q", {}, [], None)],
        [("p", {"a": {"x": 1, "y": 2}}, [{"u": 1, "w": 2}, None], ({"c": 1, "d": 2},)), ("q", {}, [], None)],
        [("p", {"a": {"x": 1, "y": 2}, "b": None}, [{"u": 1, "w": 2}, None], ({"c": 1, "d": 2},)), ("q", None, [], None)],
    ):
        changed = spark.createDataFrame(other, typ)
        assert movement.changed_partitions(src, changed, ["k"]).count() == 1


def test_removed_added_and_null_partitions(spark, rows):
    src = spark.createDataFrame([(None, 1), ("new", 2), ("same", 3)], "k string, a int")
    dst = spark.createDataFrame([(None, 9), ("old", 2), ("same", 3)], "k string, a int")
    found = movement.changed_partitions(src, dst, ["k"])
    assert rows(found) == sorted(
        [(None, "changed", 1, 1), ("new", "added", 1, 0), ("old", "removed", 0, 1)], key=repr
    )


def _mirrored(spark, src_rows, dst_rows, parts, **how):
    src, dst = make_table(src_rows, "src", parts), make_table(dst_rows, "dst", parts)
    log = movement.mirror_updates(spark, src, dst, AT, **how).first()
    left = movement.content_difference(spark.table(src), spark.table(dst).select(*spark.table(src).columns))
    assert left.count() == 0
    return src, dst, log


def test_mirror_with_null_partitions_duplicates_and_maps(spark):
    src = mixed(
        spark,
        (1, "a", {"x": 1}, None, 1),
        (1, "a", {"x": 1}, None, 1),
        (2, "b", None, "it's", 2),
        (3, "c", {}, "same", None),
    )
    dst = mixed(
        spark,
        (1, "a", {"x": 1}, None, 1),
        (3, "c", {}, "same", None),
        (4, "d", None, "gone'", None),
        (5, "e", None, None, None),
    )
    src_name, dst_name, log = _mirrored(spark, src, dst, ["p", "q"])
    assert (log.rewritten, log.dropped) == (2, 2)
    again = movement.mirror_updates(spark, src_name, dst_name, AT).first()
    assert (again.rewritten, again.dropped) == (0, 0)


def test_mirror_of_many_partitions_takes_several_scans(spark, monkeypatch):
    monkeypatch.setattr(partitions, "KEYS_PER_SCAN", 3)
    src = spark.range(60).selectExpr("id", "concat('v', id) v", "case when id % 7 <> 0 then id % 10 end p")
    dst = src.withColumn("v", F.when(F.col("p") % 2 == 0, F.lit("stale")).otherwise(F.col("v"))).filter(
        "p is not null"
    )
    _, _, log = _mirrored(spark, src, dst, ["p"])
    assert (log.rewritten, log.dropped) == (6, 0)


def test_mirror_leaves_unchanged_files_alone(spark):
    src = spark.range(100).selectExpr("id", "id % 4 p")
    dst = src.filter("p <> 3 or id < 50")
    src_name, dst_name = make_table(src, "src", ["p"]), make_table(dst, "dst", ["p"])

    def files():
        got = spark.table(dst_name).select("p", "_metadata.file_path").distinct().collect()
        return {r.file_path for r in got if r.p != 3}

    before = files()
    movement.mirror_updates(spark, src_name, dst_name, AT)
    assert files() == before
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_mirror_follows_the_ledger(spark):
    rows = spark.range(40).selectExpr("id", "id % 4 p")
    src, dst = make_table(rows, "src", ["p"]), make_table(rows, "dst", ["p"])
    # Ids are no order: the second commit has a lower one.
    ledger = commit_rows(rows, src, ["p"], 900, "2024-01-01 00:00:00", "append")
    more = spark.range(100, 104).selectExpr("id", "1 p")
    ledger = ledger.unionByName(append_rows(more, src, 5, "2024-01-02 00:00:00")).cache()
    log = movement.mirror_updates(spark, src, dst, AT, ledger=ledger, watermark=900).first()
    assert (log.snapshot_id, log.rewritten, log.dropped) == (5, 1, 0)
    assert movement.content_difference(spark.table(src), spark.table(dst)).count() == 0
    idle = movement.mirror_updates(spark, src, dst, AT, ledger=ledger, watermark=5).first()
    assert (idle.snapshot_id, idle.rewritten) == (5, 0)


def test_ledger_mirror_drops_a_partition_deleted_at_the_source(spark):
    rows = spark.range(40).selectExpr("id", "id % 4 p")
    src, dst = make_table(rows.filter("p <> 2"), "src", ["p"]), make_table(rows, "dst", ["p"])
    one = commit_rows(rows, src, ["p"], 1, "2024-01-01 00:00:00", "append")
    two = commit_rows(rows.filter("p = 2"), src, ["p"], 2, "2024-01-02 00:00:00", "delete")
    log = movement.mirror_updates(spark, src, dst, AT, ledger=one.unionByName(two), watermark=1).first()
    assert (log.rewritten, log.dropped) == (0, 1)
    assert movement.row_parity(spark.table(src), spark.table(dst)).first()["equal"]


def test_unknown_watermark_compares_everything(spark):
    rows = spark.range(40).selectExpr("id", "id % 4 p")
    src, dst = make_table(rows, "src", ["p"]), make_table(rows.filter("p <> 0 and id > 10"), "dst", ["p"])
    ledger = commit_rows(rows, src, ["p"], 1, "2024-01-01 00:00:00", "append")
    log = movement.mirror_updates(spark, src, dst, AT, ledger=ledger, watermark=77).first()
    assert log.rewritten == 4
    assert movement.content_difference(spark.table(src), spark.table(dst)).count() == 0


def test_touched_partitions_of_all_tables(spark, rows):
    ledger = spark.createDataFrame(
        [
            ("t", 9, "2024-01-01", {"p": "a"}),
            ("t", 3, "2024-01-02", {"p": "b"}),
            ("t", 7, "2024-01-03", {"p": "a"}),
            ("u", 1, "2024-01-01", {"p": "a"}),
        ],
        "table_name string, snapshot_id bigint, at string, partition_values map<string,string>",
    ).withColumn("committed_at", F.col("at").cast("timestamp_ntz"))
    marks = spark.createDataFrame([("t", 3), ("u", 1)], "table_name string, watermark bigint")
    found = movement.touched_partitions(ledger, marks)
    assert [(r.table_name, r.partition_values) for r in found.collect()] == [("t", {"p": "a"})]


def test_shared_files_are_never_written_in_place(spark):
    rows = spark.range(40).selectExpr("id", "id % 4 p")
    owner = make_table(rows, "owner", ["p"])
    target = fresh_name("target")
    manifest = movement.snapshot_table(spark, owner, target)
    assert manifest.agg(F.sum("record_count")).first()[0] == 40
    newer = make_table(rows.union(spark.range(100, 110).selectExpr("id", "id % 4 p")), "newer", ["p"])
    movement.mirror_updates(spark, newer, target, AT)
    assert spark.table(owner).count() == 40
    assert movement.content_difference(spark.table(newer), spark.table(target)).count() == 0
    assert get_property(spark, target, movement.SHARED_FILES) is None


def test_rewrite_keeps_partitioning_and_replaces_the_target(spark):
    rows = mixed(spark, (1, "a", {"x": 1}, "k", 1), (2, None, None, None, None))
    src, dst = make_table(rows, "src", ["p", "q"]), fresh_name("dst")
    for _ in range(2):
        movement.rewrite_copy(spark, src, dst, location=fresh_path(spark, "dst"))
        assert partition_columns(spark, dst) == ["p", "q"]
        assert movement.content_difference(spark.table(src), spark.table(dst)).count() == 0
    assert get_property(spark, dst, "migrated-from-source") == "true"
    assert get_property(spark, dst, "absent") is None


def test_text_table_falls_back_to_a_rewrite(spark):
    src, dst = fresh_name("text"), fresh_name("copy")
    path = fresh_path(spark, "text")
    spark.range(10).selectExpr("id", "'x' v").write.format("csv").option("path", path).saveAsTable(src)
    used = movement.copy_table(spark, src, dst, "SNAPSHOT", location=fresh_path(spark, "copy"))
    assert used == "REWRITE"
    assert spark.table(dst).count() == 10


def test_unreadable_files_are_reported(spark):
    path = fresh_path(spark, "mixed")
    rows = spark.range(10).selectExpr("id", "'x' v")
    rows.write.parquet(path)
    src, dst = fresh_name("mixed"), fresh_name("copy")
    spark.sql(f"CREATE TABLE {src} (id BIGINT, v STRING) USING parquet LOCATION '{path}'")
    rows.write.mode("append").format("csv").save(path)
    # Neither way can read such a folder: the rewrite is tried and fails as well.
    try:
        movement.copy_table(spark, src, dst, "SNAPSHOT", location=fresh_path(spark, "copy"))
    except Exception as problem:  # noqa: BLE001
        assert "csv" in str(problem)
    else:
        raise AssertionError("text files were read as Parquet")
    assert spark.read.parquet(path + "/*.parquet").count() == 10


def test_managed_tables_are_rewritten(spark):
    src, dst = fresh_name("managed"), fresh_name("copy")
    spark.range(10).selectExpr("id", "id % 2 p").write.partitionBy("p").format("parquet").saveAsTable(src)
    used = movement.copy_table(spark, src, dst, "SNAPSHOT", location=fresh_path(spark, "copy"))
    assert used == "REWRITE" and spark.table(dst).count() == 10


def test_append_is_by_position_and_checks_the_width(spark):
    table = make_table(spark.range(4).selectExpr("id", "id % 2 p"), "t", ["p"])
    ledger = append_rows(spark.range(4, 6).selectExpr("id a", "7 b"), table, 2, AT)
    assert [(r.partition_values, r.record_count) for r in ledger.collect()] == [({"p": "7"}, 2)]
    assert spark.table(table).filter("p = 7").count() == 2
    try:
        append_rows(spark.range(1), table, 3, AT)
    except ValueError:
        pass
    else:
        raise AssertionError("a row of the wrong width was taken")


def test_watermark_properties_and_in_sync(spark, rows):
    table = make_table(spark.range(3).toDF("id"), "t", [])
    set_properties(spark, table, {movement.WATERMARK: "12"})
    other = make_table(spark.range(3).toDF("id"), "t", [])
    marks = movement.watermark_properties(spark, [table, other])
    assert rows(marks) == sorted([(table, 12), (other, None)], key=repr)
    ledger = spark.createDataFrame([(table, 12, AT), (other, 13, AT)], "table_name string, snapshot_id bigint, committed_at string")
    got = movement.in_sync(marks.select("table_name"), ledger, marks)
    assert {r.table_name: r.in_sync for r in got.collect()} == {table: True, other: False}


def test_empty_inputs(spark):
    none = spark.createDataFrame([], "k string, a int")
    assert movement.row_parity(none, none).first().asDict() == {"n_src": 0, "n_dst": 0, "equal": True}
    assert movement.stats_total(movement.partition_stats(none, ["k"])).first().record_count == 0
    assert movement.changed_partitions(none, none, ["k"]).count() == 0


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == shared_folder(spark)


def test_filter_on_named_partitions_prunes_the_scan(spark):
    table = make_table(spark.range(40).selectExpr("id", "id % 4 p"), "t", ["p"])
    wanted = spark.createDataFrame([(1,)], "p bigint")
    plan = partitions.only_partitions(spark.table(table), wanted, ["p"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: []" not in text and "DataFilters: []" in text
    read = partitions.only_partitions(spark.table(table), wanted, ["p"]).select("_metadata.file_path")
    assert all("/p=1/" in r[0] for r in read.distinct().collect()) and read.count() == 10


def test_scans_stay_pruned_for_any_number_of_partitions(spark):
    src = make_table(spark.range(1200).selectExpr("id", "id % 600 p"), "src", ["p"])
    wanted = spark.range(450).selectExpr("id p")
    found = partitions.only_partitions(spark.table(src), wanted, ["p"])
    folders = {r[0].rsplit("/", 2)[1] for r in found.select("_metadata.file_path").distinct().collect()}
    assert found.count() == 900 and folders == {f"p={k}" for k in range(450)}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: []" not in plan and "DataFilters: []" in plan


def test_snapshot_follows_the_catalogue_not_the_folders(spark):
    src = make_table(spark.range(100).selectExpr("id", "concat('a b%', id % 3) p"), "src", ["p"])
    elsewhere = fresh_path(spark, "elsewhere")
    spark.range(7).write.parquet(elsewhere)
    spark.sql(f"ALTER TABLE {src} ADD PARTITION (p = 'far') LOCATION '{elsewhere}'")
    dst = fresh_name("snap")
    manifest = movement.snapshot_table(spark, src, dst)
    assert spark.table(dst).count() == 107 == manifest.agg({"record_count": "sum"}).first()[0]
    assert movement.changed_partitions(spark.table(src), spark.table(dst), ["p"]).count() == 0


def test_a_swap_back_drops_what_is_in_the_way(spark):
    from carryall.operators import catalog as cat
    from carryall.schemas import KEY
    from carryall.sources.tables import run_drops, run_renames

    old = "t_" + fresh_name("swap")
    for suffix, n in (("", 1), ("_source_archived", 2), ("_target_archived", 3)):
        spark.range(n).write.saveAsTable(f"default.{old}{suffix}")

    def entry(suffix, kind, tags):
        return ("spark_catalog", "default", old + suffix, kind, tags)

    columns = "catalog_name string, db_name string, tbl_name string, table_type string, tags array<string>"
    rows = [entry("", "ICEBERG", ["x"]), entry("_source_archived", "EXTERNAL", ["do_not_rename"]), entry("_target_archived", "ICEBERG", ["do_not_drop"])]
    fleet = spark.createDataFrame(rows, columns).selectExpr("*", "cast(null as string) serde_uri", "cast(null as boolean) secure")
    job = spark.createDataFrame([("spark_catalog", "default", old)], ", ".join(f"{k} string" for k in KEY))
    edits, _ = cat.swap_back_finalized(job, fleet)
    drops = cat.drop_plan(edits, fleet).collect()
    assert [(r.tbl_name, r.held_tags) for r in drops] == [(f"{old}_target_archived", ["do_not_drop"])]
    for _ in range(2):  # dropping again is no error
        assert run_drops(spark, cat.drop_plan(edits, fleet)) == 1
    assert run_renames(spark, cat.rename_plan(edits, fleet)) == 2
    assert spark.table(f"default.{old}").count() == 2
    assert spark.table(f"default.{old}_target_archived").count() == 1


def test_newest_snapshots_are_hashed_not_sorted(spark):
    ledger = spark.sql(
        "SELECT * FROM VALUES ('a', 5L, TIMESTAMP_NTZ '2024-01-02', MAP('d', '1')),"
        " ('a', 9L, TIMESTAMP_NTZ '2024-01-01', MAP('d', '1')), ('a', 4L, TIMESTAMP_NTZ '2024-01-02', MAP('d', '2')),"
        " ('b', 1L, NULL, MAP('d', '1')), ('b', 2L, NULL, MAP('d', '1'))"
        " AS t(table_name, snapshot_id, committed_at, partition_values)"
    )
    marks = spark.sql("SELECT 'a' AS table_name, 4L AS watermark")
    latest = movement.latest_snapshot(ledger)
    touched = movement.touched_partitions(ledger, marks)
    assert sorted(map(tuple, latest.collect())) == [("a", 5), ("b", 2)]
    assert sorted((t, p["d"]) for t, p in touched.collect()) == [("a", "1"), ("b", "1")]
    for frame in (latest, touched):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan and "HashAggregate" in plan

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from carryall import vocabulary as v
from carryall.functions.shards import number_rows, shard_of
from carryall.operators import enrich, selectors
from carryall.schemas import JOB, KEY
from carryall.sources import queue

AS_OF = "2024-03-01 12:00:00"


def job(task_id=1, **over):
    row = {f.name: None for f in JOB.fields} | {
        "task_id": task_id,
        "catalog_name": "cat",
        "db_name": "db",
        "tbl_name": f"t{task_id}",
        "stg_format": "parquet",
        "tbl_owners": [],
        "downstream_users": [],
        "to_be_processed": 0,
        "in_process": 0,
        "state": v.NEW,
        "desired_state": v.NEW,
        "initial_gap_days": 14,
        "probation_gap_days": 7,
        "migration_paused": 0,
        "pause_reason": "None",
    }
    return tuple((row | over).values())


def jobs(spark, *rows):
    return spark.createDataFrame(list(rows), JOB)


def test_decode_then_encode_is_stable(spark, rows):
    raw = spark.createDataFrame(
        [(1, "c", None, "t", '["b","a","b"]', "[]")],
        "task_id int, catalog_name string, db_name string, tbl_name string, tbl_owners string, downstream_users string",
    )
    typed = queue.decode_jobs(raw)
    assert typed.schema.fieldNames() == JOB.fieldNames()
    one = typed.first()
    assert (one.db_name, one.tbl_owners, one.downstream_users, one.state) == ("", ["a", "b"], [], v.NEW)
    stored = queue.encode_jobs(typed)
    assert (stored.first().tbl_owners, stored.first().downstream_users) == ('["a","b"]', None)
    assert rows(queue.decode_jobs(stored)) == rows(typed)


def test_decode_renames_states(spark):
    raw = spark.createDataFrame([("waiting", "done")], "state string, desired_state string")
    one = queue.decode_jobs(raw, {"waiting": v.READY}).first()
    assert (one.state, one.desired_state) == (v.READY, "done")


def test_upsert_is_idempotent_and_ignores_unknown_keys(spark, rows):
    before = jobs(spark, job(1), job(2))
    changes = jobs(spark, job(1, state=v.READY), job(9, state=v.READY))
    once = queue.upsert_jobs(before, changes, AS_OF)
    assert rows(once, "task_id", "state") == [(1, v.READY), (2, v.NEW)]
    assert rows(queue.upsert_jobs(once, changes, AS_OF)) == rows(once)
    assert rows(once.filter("task_id = 2")) == rows(before.filter("task_id = 2"))


def test_upsert_can_set_null(spark):
    before = jobs(spark, job(1, shadow_status=v.MIRRORING))
    after = queue.upsert_jobs(before, jobs(spark, job(1)), AS_OF)
    assert after.first().shadow_status is None


def test_ingest_twice_adds_nothing(spark, rows):
    lines = spark.createDataFrame([("a/b/c",), ("a/b/c",), ("a/b/d/",), ("a/b",), ("",), (None,)], "value string")
    start = jobs(spark, job(41))
    new, rejects = queue.ingest_tables(lines, start, AS_OF)
    assert sorted(r.task_id for r in new.collect()) == [42, 43]
    assert rows(new, *KEY) == [("a", "b", "c"), ("a", "b", "d")]
    assert rows(rejects) == sorted([("a/b",), ("",), (None,)], key=repr)
    again, _ = queue.ingest_tables(lines, start.unionByName(new), AS_OF)
    assert again.count() == 0


def test_ingest_into_empty_queue_starts_at_one(spark):
    lines = spark.createDataFrame([("a/b/c",)], "value string")
    new, _ = queue.ingest_tables(lines, jobs(spark, job()).limit(0), AS_OF)
    assert new.first().task_id == 1


def test_table_list_forms(spark, rows):
    lines = spark.createDataFrame([(" Cat.Db.T , a.b ",), ("x.y.z",)], "value string")
    keys, rejects = queue.read_table_list(lines)
    assert rows(keys) == [("cat", "db", "t"), ("x", "y", "z")]
    assert rows(rejects) == [(" a.b ",)]
    keys, _ = queue.read_table_list(spark.createDataFrame([("Cat/Db/T",)], "value string"), "/")
    assert rows(keys) == [("Cat", "Db", "T")]


@pytest.mark.parametrize("shards", [1, 3, 7, 16, 1000, 2**31 - 1])
def test_shards_equal_big_integer_arithmetic(spark, shards):
    ids = [0, 1, 2, 3, 4, 5, 452391, 10**12]
    got = spark.createDataFrame([(i,) for i in ids], "id bigint").select("id", shard_of(F.col("id"), shards))
    want = {i: int(hashlib.md5(str(i).encode()).hexdigest(), 16) % shards + 1 for i in ids}
    assert dict(map(tuple, got.collect())) == want


def test_shard_vectors(spark):
    ids = spark.range(6)
    for shards, want in ((3, [2, 2, 1, 2, 3, 1]), (7, [1, 3, 3, 6, 6, 4]), (16, [11, 12, 13, 4, 13, 6])):
        got = ids.select("id", shard_of(F.col("id"), shards).alias("s")).orderBy("id").collect()
        assert [r.s for r in got] == want


def test_numbering_has_no_gaps_in_a_hot_group(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 40)).alias("g"),
        F.col("id").cast("string").alias("m"),
    )
    out = number_rows(df, ["g"], ["m"], "n", total="all").collect()
    assert len(out) == 5000
    seen = {}
    for r in out:
        seen.setdefault(r.g, []).append(r.n)
        assert r["all"] == sum(1 for x in out if x.g == r.g) if r.n == 1 else True
    for numbers in seen.values():
        assert sorted(numbers) == list(range(1, len(numbers) + 1))


def test_selectors_keep_strict_bounds(spark):
    exact = "2024-02-16 12:00:00"
    earlier = "2024-02-16 11:59:59"
    base = jobs(
        spark,
        job(1, state=v.READY, desired_state=v.LOCKED, to_be_processed=1),
        job(2, state=v.READY, desired_state=v.LOCKED, to_be_processed=1),
    )
    when = F.when(F.col("task_id") == 1, exact).otherwise(earlier).cast("timestamp_ntz")
    due = selectors.select_migrate(base.withColumn("comm_level1_date", when), AS_OF)
    assert [r.task_id for r in due.collect()] == [2]


def test_limit_is_taken_after_the_shard(spark):
    many = jobs(spark, *[job(i) for i in range(40)])
    picked = selectors.select_preprocess(many, AS_OF, limit=5, shard=(2, 3))
    mine = [r.task_id for r in selectors.assign_shard(many, 3, keep=2).orderBy("task_id").collect()]
    assert sorted(r.task_id for r in picked.collect()) == mine[:5]


def test_reader_sets_hold_everyone(spark):
    pairs = spark.createDataFrame(
        [("hot", f"u{i}") for i in range(10_001)] + [("small", "b"), ("small", "a"), ("small", "a")], "k string, m string"
    )
    folded = {r.k: r.ms for r in enrich.fold_sets(pairs, ["k"], "m", "ms").collect()}
    assert folded["small"] == ["a", "b"] and len(folded["hot"]) == 10_001


def test_owner_fallback_order(spark):
    contacts = spark.createDataFrame([("a", ["x@example.com"]), ("b", []), ("c", [])], "table_name string, contacts array<string>")
    daily = spark.createDataFrame(
        [("a", ["no@example.com"], 20240229), ("b", [], 20240229), ("c", ["old@example.com"], 20240228)],
        "table_name string, contacts array<string>, dateint int",
    )
    doc = '{"definitionMetadata":{"owner":{"userId":"%s"}}}'
    events = spark.createDataFrame(
        [(t, n, doc % u) for t, n, u in (("b", 1, "z"), ("c", 1, "first"), ("c", 2, "last"), ("d", 1, "d"))],
        "table_name string, event_time int, current_json string",
    )
    got = {r.table_name: r.owners for r in enrich.owner_candidates(contacts, daily, events, 20240229).collect()}
    # b: an existing daily row ends the search even though it is empty.
    assert got == {"a": ["x@example.com"], "b": [], "c": ["last@example.com"], "d": ["d@example.com"]}


def test_timestamp_columns(spark):
    cases = [
        ([("timestamp", "timestamp")], False),
        ([("a", "TIMESTAMP")], True),
        ([("a", "struct<timestamp:bigint>")], False),
        ([("a", "array<struct<x:timestamp>>")], True),
        ([("a", None)], False),
        (None, False),
        ([], False),
    ]
    df = spark.createDataFrame(
        [(i, c) for i, (c, _) in enumerate(cases)], "i int, fields array<struct<name:string,source_type:string>>"
    )
    got = {r.i: r.has_ts for r in enrich.detect_rewrite_types(df).collect()}
    assert got == {i: want for i, (_, want) in enumerate(cases)}

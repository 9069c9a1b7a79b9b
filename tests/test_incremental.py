"""What is kept step by step equals what is made from everything, and reads new input only."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from carryall.plans import fixtures
from carryall.operators import enrich, movement
from carryall.sources import queue
from carryall.sources.ledger import LedgerSummary
from carryall.sources.readers import ReaderPairs
from carryall.sources.tables import fresh_path, probe_folders

_LEDGER = "table_name string, partition_values map<string,string>, committed_at timestamp_ntz, snapshot_id long"


def _at(day, hour=0):
    return datetime.datetime(2024, 1, day, hour)


def _ledger_rows():
    out = []
    for n in range(40):
        part = {"p": str(n % 3)} if n % 5 else {"p": None}
        out.append((f"t{n % 2}", part, _at(1 + n * 7 % 28, n % 24), 1000 - n))
    return out + [(None, {}, None, 7), ("t0", {}, None, 8)]


def test_ledger_summary_equals_full_aggregation(spark, rows):
    path = fresh_path(spark, "ledger")
    all_rows = _ledger_rows()
    summary = None
    # Newest first: files come in any order of commits.
    for part in (all_rows[25:], all_rows[:10], all_rows[10:25]):
        spark.createDataFrame(part, _LEDGER).coalesce(1).write.mode("append").parquet(path)
        summary = summary or LedgerSummary(spark, path)
        assert summary.fold() == 1
        assert summary.fold() == 0
    whole = spark.createDataFrame(all_rows, _LEDGER)
    key = ["table_name", F.to_json("partition_values").alias("p"), "committed_at", "snapshot_id"]
    assert rows(summary.partitions(), *key) == rows(movement.partition_commits(whole), *key)
    assert rows(movement.latest_snapshot(summary.partitions())) == rows(movement.latest_snapshot(whole))
    marks = spark.createDataFrame([("t0", 990), ("t1", -7)], "table_name string, watermark long")
    shown = ["table_name", F.to_json("partition_values").alias("p")]
    kept = movement.touched_partitions(summary.partitions(), marks, summary.commits())
    assert rows(kept, *shown) == rows(movement.touched_partitions(whole, marks), *shown)


def test_ledger_summary_after_a_fold_that_was_cut_off(spark, rows, monkeypatch):
    path = fresh_path(spark, "ledger")
    spark.createDataFrame(_ledger_rows(), _LEDGER).coalesce(2).write.parquet(path)
    summary = LedgerSummary(spark, path)
    replace = summary._last.replace

    def cut_off(given):
        replace(given)
        raise OSError("lost")

    monkeypatch.setattr(summary._last, "replace", cut_off)
    try:
        summary.fold()
    except OSError:
        pass
    monkeypatch.undo()
    assert summary.fold() == 2
    whole = spark.createDataFrame(_ledger_rows(), _LEDGER)
    assert rows(movement.latest_snapshot(summary.partitions())) == rows(movement.latest_snapshot(whole))


_LINEAGE = "source_name string, operation string, user_id string, day date"


def test_reader_pairs_read_new_days_only(spark, rows):
    first, second, third = (datetime.date(2024, 1, d) for d in (1, 2, 3))
    pairs = ReaderPairs(spark)
    old = [("a", "read", "u", first), ("a", "read", "u", second), ("b", "write", "u", first)]
    assert pairs.update(spark.createDataFrame(old, _LINEAGE), second) == [first]
    # What a closed day has now is not seen; the open day and rows without one are.
    now = [("x", "read", "late", first), ("c", "read", "v", second), ("a", "read", "u", third), ("d", "read", "w", None), ("d", "read", None, third)]
    assert pairs.update(spark.createDataFrame(now, _LINEAGE), third) == [second]
    mail = "@example.com"
    assert rows(pairs.read()) == [("a", f"u{mail}"), ("c", f"v{mail}"), ("d", f"w{mail}")]
    assert pairs.update(spark.createDataFrame([], _LINEAGE), third) == []
    assert rows(pairs.closed_days()) == [(first,), (second,)]


def test_reader_pairs_are_not_doubled_by_a_second_try(spark, rows):
    day = datetime.date(2024, 1, 1)
    lineage = spark.createDataFrame([("a", "read", "u", day), ("a", "read", "u", day)], _LINEAGE)
    pairs = ReaderPairs(spark)
    for _ in range(2):
        # An open day stays to be read.
        assert pairs.update(lineage, day) == []
    assert rows(pairs.read()) == [("a", "u@example.com")]


_QUEUE = "task_id long, catalog_name string, db_name string, tbl_name string, state string, last_updated_time timestamp_ntz, version long"
_CHANGE = "task_id long, catalog_name string, db_name string, tbl_name string, state string, version long, changed_at timestamp_ntz"


def test_settled_changes(spark, rows):
    jobs = spark.createDataFrame([(n, "c", "d", f"t{n}", "NEW", _at(1), 5) for n in range(4)], _QUEUE)
    changes = spark.createDataFrame(
        [
            (0, "c", "d", "t0", "READY", 5, _at(2)),
            (0, "c", "d", "t0", "LOCKED", 5, _at(3)),
            # Newer, but made from an older row.
            (0, "c", "d", "t0", "OPEN", 4, _at(4)),
            (1, "c", "d", "t1", "READY", 5, _at(2)),
            (1, "c", "d", "t1", "READY", 5, _at(2)),
            (2, "c", "d", "t2", "READY", 5, None),
            (9, "c", "d", "t9", "READY", 5, _at(2)),
            (3, "c", None, "t3", "READY", 5, _at(2)),
            (3, "c", "d", "t3", "READY", None, _at(2)),
        ],
        _CHANGE,
    )
    made, rejects = queue.settle_changes(jobs, changes)
    assert rows(made, "task_id", "state") == [(0, "LOCKED"), (1, "READY"), (2, "READY")]
    assert rows(rejects, "task_id", "state", "reason") == [
        (0, "OPEN", "stale"),
        (0, "READY", "superseded"),
        (3, "READY", "stale"),
        (3, "READY", "unknown"),
        (9, "READY", "unknown"),
    ]
    done = queue.upsert_jobs(jobs, made, _at(9))
    assert rows(done, "task_id", "state", "version") == [(0, "LOCKED", 6), (1, "READY", 6), (2, "READY", 6), (3, "NEW", 5)]
    # The same changes once more were made from rows that are gone.
    again, late = queue.settle_changes(done, made)
    assert again.count() == 0 and {r["reason"] for r in late.collect()} == {"stale"}


def test_settled_changes_are_the_same_in_parts(spark, rows):
    jobs = spark.createDataFrame([(n, "c", "d", None if n == 5 else f"t{n}", "NEW", _at(1), 5) for n in [*range(40), 7]], _QUEUE)
    changes = spark.createDataFrame(
        [(n % 50 if n % 17 else None, "c", "d", None if n % 50 == 5 else f"t{n % 50}", "READY", 5 if n % 3 else 4, _at(1 + n % 4) if n % 11 else None) for n in range(300)],
        _CHANGE,
    )
    want = [rows(x) for x in queue.settle_changes(jobs, changes)]
    made, rejects = queue.settle_changes(jobs, changes, parts=7)
    assert [rows(made), rows(rejects)] == want and all(want)
    # As many tasks as parts, so that more changes mean more tasks and not longer sorts.
    assert rejects.rdd.getNumPartitions() == 7


def test_settled_parts_grow_with_the_changes(spark, monkeypatch):
    sf = "/root/testdata/sf0.001"
    n = spark.read.parquet(f"{sf}/lineitem.parquet").count()
    assert fixtures.parts_of(spark, sf, "changes") is None
    monkeypatch.setattr(fixtures, "_PART_ROWS", 500)
    assert fixtures.parts_of(spark, sf, "changes") == n // 500 > 2


def test_contradicting_changes_of_one_time_leave_one(spark):
    jobs = spark.createDataFrame([(0, "c", "d", "t", "NEW", _at(1), 0)], _QUEUE).drop("version")
    changes = spark.createDataFrame([(0, "c", "d", "t", s, 0, _at(2)) for s in ("READY", "LOCKED", "OPEN")], _CHANGE)
    made, rejects = queue.settle_changes(jobs, changes.drop("version"))
    assert made.count() == 1 and rejects.count() == 2


def test_newest_event_names_the_owner(spark, rows):
    def document(user):
        return '{"definitionMetadata":{}}' if user is None else f'{{"definitionMetadata":{{"owner":{{"userId":"{user}"}}}}}}'

    events = spark.createDataFrame(
        [("a", _at(1), document("old")), ("a", _at(2), document("new")), ("a", None, document("none")), ("a", _at(3), ""),
         ("b", _at(2), document(None)), ("b", _at(1), document("old")), ("c", None, document("only")), ("", _at(1), document("x")), (None, _at(1), document("y"))],
        "table_name string, event_time timestamp_ntz, current_json string",
    )
    found = enrich.event_owners(events)
    assert [r for r in rows(found) if r[0]] == [("a", "new"), ("b", None), ("c", "only")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def test_owner_candidates_of_repeated_rows(spark, rows):
    kind = "table_name string, contacts array<string>"
    contacts = spark.createDataFrame([("a", ["x"]), ("a", ["x"]), ("a", ["y"]), ("b", []), ("b", None), ("z", ["z"])], kind)
    daily = spark.createDataFrame([("a", ["d"], 1), ("b", [], 1), ("c", ["d"], 2)], kind + ", dateint int")
    events = spark.createDataFrame([], "table_name string, event_time timestamp_ntz, current_json string")
    due = spark.createDataFrame([("a",), ("b",), ("c",)], "table_name string")
    found = rows(enrich.owner_candidates(contacts, daily, events, 1, due=due))
    assert [(t, r) for t, _, r in found] == [("a", 1), ("b", 2)]
    assert found[0][1] in (["x"], ["y"]) and found[1][1] == []


def test_probe_of_many_tables_is_a_fixed_number_of_jobs(spark, rows):
    def located(n):
        path = fresh_path(spark, "probe")
        spark.range(n).select("id", F.col("id").alias("t")).write.partitionBy("t").parquet(path)
        spark.range(0).write.parquet(f"{path}/empty")
        keys = [("c", "d", f"t{k}", f"{path}/t={k}/") for k in range(n)]
        keys += [("c", "d", "none", f"{path}/empty"), ("c", "d", "away", f"{path}/away"), ("c", "d", "null", None), ("c", "d", "t0", f"file:{path}/t=0")]
        return spark.createDataFrame(keys, "catalog_name string, db_name string, tbl_name string, location string")

    tracker = spark.sparkContext.statusTracker()
    numbers = []
    for n in (3, 20):
        given = located(n)
        spark.sparkContext.setJobGroup(f"probe{n}", "probe")
        found = rows(probe_folders(spark, given), "tbl_name")
        numbers.append(len(tracker.getJobIdsForGroup(f"probe{n}")))
        assert found == sorted((f"t{k}",) for k in range(n))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert numbers[0] == numbers[1]


def test_probe_of_other_formats(spark, rows):
    path = fresh_path(spark, "text probe+1%")
    spark.createDataFrame([("x",)], "value string").coalesce(1).write.text(f"{path}/full")
    spark.createDataFrame([], "value string").write.text(f"{path}/none")
    spark.range(1).write.parquet(f"{path}/parquet")
    def at(name):
        return spark.createDataFrame([("c", "d", name, f"{path}/{name}")], "catalog_name string, db_name string, tbl_name string, location string")
    both = at("full").union(at("none"))
    assert rows(probe_folders(spark, both, "text"), "tbl_name") == [("full",)]
    assert rows(probe_folders(spark, at("parquet")), "tbl_name") == [("parquet",)]
    assert rows(probe_folders(spark, both.limit(0))) == []


def test_ranges_name_what_changed_inside_a_partition(spark, rows):
    kind = "p string, k long, v string"
    src = [("a", k, "x") for k in (-5, -1, 0, 9, 10, 25, None)] + [(None, 3, "x"), ("b", 1, None), ("b", 1, None)]
    dst = [("a", k, "x" if k != 25 else "y") for k in (-5, -1, 0, 9, 10, 25)] + [("a", None, None), (None, 3, "z"), ("b", 1, None)]
    left, right = spark.createDataFrame(src, kind), spark.createDataFrame(dst, kind)
    ranges = movement.changed_ranges(left, right, ["p"], "k", 10)
    assert rows(ranges) == sorted(
        [("a", 20, 29, 1, 1), ("a", None, None, 1, 1), (None, 0, 9, 1, 1), ("b", 0, 9, 2, 1)], key=repr
    )
    proof = movement.range_difference(left, right, ["p"], "k", ranges)
    assert rows(proof) == rows(movement.content_difference(left, right))
    same = movement.range_difference(left, left, ["p"], "k", movement.changed_ranges(left, left, ["p"], "k", 10))
    assert rows(same) == []
    whole = movement.changed_ranges(left.drop("p"), right.drop("p"), [], "k", 10)
    assert rows(movement.range_difference(left.drop("p"), right.drop("p"), [], "k", whole)) == rows(
        movement.content_difference(left.drop("p"), right.drop("p"))
    )


def test_proof_of_ranges_reads_few_row_groups(spark):
    path, other = fresh_path(spark, "left"), fresh_path(spark, "right")
    rows_ = spark.range(0, 200_000, 1, 20).select("id", F.lit("x").alias("v"))
    rows_.write.parquet(path)
    rows_.withColumn("v", F.when(F.col("id") == 77_777, "y").otherwise(F.col("v"))).write.parquet(other)
    left, right = spark.read.parquet(path), spark.read.parquet(other)
    ranges = movement.changed_ranges(left, right, [], "id", 1000)
    assert ranges.collect() == [(77_000, 77_999, 1000, 1000)]
    proof = movement.range_difference(left, right, [], "id", ranges)
    plan = proof._jdf.queryExecution().executedPlan().toString()
    assert "77999" in plan and "PushedFilters" in plan
    assert sorted(tuple(r) for r in proof.collect()) == [(77_777, "x", 1, 0), (77_777, "y", 0, 1)]


def test_a_fixture_over_a_large_table_is_joined_in_bounded_parts(spark, tmp_path, rows, monkeypatch):
    def built(part_rows):
        monkeypatch.setattr(fixtures, "_PART_ROWS", part_rows)
        fixtures._built.clear()
        return fixtures.fixture(spark, str(tmp_path), "changes")

    spark.sql(
        "select id o_orderkey, id o_custkey, 'O' o_orderstatus, '1-URGENT' o_orderpriority,"
        " timestamp_ntz'1996-01-01 00:00:00' o_orderdate from range(60)"
    ).write.parquet(str(tmp_path / "orders.parquet"))
    # An order that a third of all lines have, and lines that repeat.
    spark.sql(
        "select if(id % 3 = 0, 7, id % 50) l_orderkey, cast(id % 6 as int) l_linenumber,"
        " timestamp_ntz'1996-02-01 00:00:00' + make_dt_interval(cast(id % 90 as int)) l_shipdate from range(600)"
    ).write.parquet(str(tmp_path / "lineitem.parquet"))
    small, large = built(200_000), built(10)
    spread = "RepartitionByExpression"
    assert spread not in small._jdf.queryExecution().optimizedPlan().toString()
    plan = large._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(spread) == 2 and "60" in plan[plan.index(spread) :].split("\n")[0]
    assert rows(small) == rows(large) and len(rows(small)) > 300
    fixtures._built.clear()

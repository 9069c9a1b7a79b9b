"""Runs carried out on real tables: failures apart, cut-off runs resumed, and all the way back."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from carryall import vocabulary as v
from carryall.operators import movement
from carryall.plans import conduct
from carryall.plans.movement_queries import make_table
from carryall.schemas import CATALOG, JOB, KEY
from carryall.sources import appends, tables
from carryall.sources.store import Journal, StoredTable

CAT, DB = "spark_catalog", "default"
AT = "2024-03-01 00:00:00"


def entry(name, **over):
    row = {f.name: None for f in CATALOG.fields} | {
        "catalog_name": CAT, "db_name": DB, "tbl_name": name, "table_type": "EXTERNAL_TABLE",
        "output_format": "x.MapredParquetOutputFormat", "data_uri": f"file:/{name}", "data_size": 9, "tags": ["do_not_drop"],
        "fields": [("id", "bigint"), ("p", "bigint")],
    }
    return tuple((row | over).values())


def job(task_id, name, **over):
    row = {f.name: None for f in JOB.fields} | {
        "task_id": task_id, "catalog_name": CAT, "db_name": DB, "tbl_name": name, "stg_format": "parquet",
        "to_be_processed": 1, "in_process": 0, "state": v.READY, "desired_state": v.LOCKED, "initial_gap_days": 1,
        "probation_gap_days": 7, "migration_paused": 0, "pause_reason": "None", "comm_level1_date": None,
    }
    return tuple((row | over).values())


class World:
    def __init__(self, spark, missing=()):
        self.spark = spark
        self.names = [tables.fresh_name("run") for _ in range(3)]
        for n, name in enumerate(self.names):
            if n not in missing:
                self.make(n)
        jobs = spark.createDataFrame([job(n, name) for n, name in enumerate(self.names)], JOB)
        jobs = jobs.withColumn("comm_level1_date", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
        catalog = spark.createDataFrame([entry(name) for name in self.names], CATALOG)
        self.control = conduct.Control(
            spark, StoredTable(spark, jobs, "queue"), StoredTable(spark, catalog, "catalog"), Journal(spark), width=3
        )
        self.empty = jobs.select(*KEY).limit(0)

    def make(self, n):
        make_table(self.spark.range(20).selectExpr("id", "id % 4 p"), "run", ["p"], name=self.names[n])

    def states(self):
        rows = self.control.queue.read().orderBy("task_id").collect()
        return [(r.state, r.desired_state, r.migration_paused) for r in rows]

    def migrate(self, run_id):
        return conduct.migrate_run(self.control, self.empty, AT, run_id)

    def tables(self):
        found = self.control.catalog.read().orderBy("tbl_name").collect()
        return {r.tbl_name: r.table_type for r in found}


OPEN = (v.OPEN, v.OPEN, 0)


def test_a_failing_table_leaves_the_others_alone_and_is_taken_up_again(spark):
    w = World(spark, missing=[1])
    stages = {(r.task_id, r.stage): (r.outcome, r.detail) for r in w.migrate("r1").collect()}
    assert w.states() == [OPEN, (v.LOCKED, v.COPIED, 0), OPEN]
    assert stages[1, "copy"][0] == Journal.FAILED and "TABLE_OR_VIEW_NOT_FOUND" in stages[1, "copy"][1]
    assert {k for k, x in stages.items() if x[0] == Journal.DONE} == {
        *((t, s) for t in (0, 2) for s in ("lock", "copy", "promote", "unlock")), (1, "lock"),
    }
    w.make(1)
    again = {(r.task_id, r.stage): r.outcome for r in w.migrate("r1").collect()}
    assert w.states() == [OPEN] * 3 and set(again.values()) == {Journal.DONE}
    for name in w.names:
        source = spark.table(f"{name}_source")
        assert movement.content_difference(source, spark.table(name).select(*source.columns)).count() == 0
        assert w.tables()[name] == "ICEBERG" and w.tables()[f"{name}_source"] == "EXTERNAL_TABLE"
    target = w.control.catalog.read().filter(F.col("tbl_name") == w.names[0]).first()
    assert "migrated_from_source" in target.tags and target.migrated_data_location == f"file:/{w.names[0]}"


@pytest.mark.parametrize("store,nth", [("catalog", 3), ("queue", 3)])
def test_a_run_cut_off_goes_on(spark, store, nth):
    """Cut off after the renames of a promotion, or after a copy, before the queue has it."""
    w = World(spark)
    stored = getattr(w.control, store)
    replace, calls = stored.replace, []

    def broken(rows):
        calls.append(1)
        if len(calls) == nth:
            raise KeyboardInterrupt("the driver is gone")
        replace(rows)

    stored.replace = broken
    with pytest.raises(KeyboardInterrupt):
        w.migrate("r1")
    stored.replace = replace
    assert w.states() != [OPEN] * 3
    copies = {r.detail for r in w.control.journal.stages("r1").collect() if r.stage == "copy"}
    stages = w.migrate("r1").collect()
    assert w.states() == [OPEN] * 3 and {r.outcome for r in stages} == {Journal.DONE}
    # What was copied before the cut was not copied again.
    assert {r.detail for r in stages if r.stage == "copy"} == copies
    kinds = w.tables()
    assert sorted(kinds) == sorted([*w.names, *(f"{n}_source" for n in w.names)])
    for name in w.names:
        assert spark.table(name).count() == spark.table(f"{name}_source").count() == 20 and kinds[name] == "ICEBERG"


def test_probation_mirror_and_revert(spark):
    w = World(spark)
    w.migrate("r1")
    ledger = None
    for n, name in enumerate(w.names):
        rows = appends.append_rows(spark.range(100, 103).selectExpr("id", "7 p"), name, 5, AT)
        rows = rows.withColumn("table_name", F.lit(f"{CAT}/{DB}/{name}"))
        ledger = rows if ledger is None else ledger.unionByName(rows)
    no_log = spark.createDataFrame([], "table_name string, snapshot_id bigint, mirrored_at timestamp_ntz")
    # One kept source is gone: its table fails, the others are mirrored and logged.
    spark.sql(f"ALTER TABLE {w.names[1]}_source RENAME TO {w.names[1]}_lost")
    log, outcomes = conduct.mirror_run(w.control, ledger, no_log, AT, "m1")
    assert {r.task_id: r.outcome for r in outcomes.collect()} == {0: "mirrored", 1: "failed", 2: "mirrored"}
    assert log.count() == 2 and w.control.queue.read().filter("shadow_status is not null").count() == 0
    spark.sql(f"ALTER TABLE {w.names[1]}_lost RENAME TO {w.names[1]}_source")
    log = log.unionByName(conduct.mirror_run(w.control, ledger, log, AT, "m2")[0])
    assert log.count() == 3
    for name in w.names:
        assert spark.table(f"{name}_source").count() == 23

    asked = spark.createDataFrame([(CAT, DB, w.names[0]), (CAT, DB, "unknown")], ", ".join(f"{k} string" for k in KEY))
    appends.append_rows(spark.range(200, 201).selectExpr("id", "1 p"), w.names[0], 6, AT)
    replace = w.control.catalog.replace

    def broken(rows):
        replace(rows)
        if not w.control.catalog.read().filter(F.col("tbl_name") == w.names[0] + "_source").count():
            raise KeyboardInterrupt("the driver is gone")

    w.control.catalog.replace = broken
    with pytest.raises(KeyboardInterrupt):
        conduct.revert_run(w.control, asked, AT, "v1")
    w.control.catalog.replace = replace
    stages, rejects = conduct.revert_run(w.control, asked, AT, "v1")
    assert [r.reason for r in rejects.collect()] == ["unknown table"]
    assert {r.stage for r in stages.collect()} == {"unarchive_source", "lock", "mirror_back", "restore", "unlock", "retire_target"}
    assert {r.outcome for r in stages.collect()} == {Journal.DONE}
    assert w.states() == [(v.TARGET_RETIRED, v.TARGET_RETIRED, 1), OPEN, OPEN]
    name = w.names[0]
    assert spark.table(name).count() == 24 == spark.table(f"{name}_target_revert").count()
    assert w.tables()[name] == "EXTERNAL_TABLE"

    # A finished migration, swapped back; a second time there is nothing to swap.
    other = w.names[2]
    moved = w.control.queue.read().filter("task_id = 2").withColumns({"desired_state": F.lit(v.SOURCE_ARCHIVED), "in_process": F.lit(1)})
    w.control.put(moved, AT)
    w.migrate("r2")
    assert w.states()[2] == (v.SOURCE_ARCHIVED, v.SOURCE_ARCHIVED, 0)
    asked = spark.createDataFrame([(CAT, DB, other)], ", ".join(f"{k} string" for k in KEY))
    for _ in range(2):
        stages, told = conduct.revert_finalized_run(w.control, asked, AT, "f1")
        assert [tuple(r)[3:] for r in told.collect()] == [(True, None)]
    assert w.states()[2] == (v.READY, v.LOCKED, 1)
    assert w.tables()[other] == "EXTERNAL_TABLE" and spark.table(other).count() == 23
    assert spark.table(f"{other}_target_archived").count() == 23


def test_a_mirror_run_cut_off_is_taken_up_by_the_next(spark):
    w = World(spark)
    w.migrate("r1")
    stuck = w.control.queue.read().withColumn("shadow_status", F.lit(v.MIRRORING))
    w.control.put(stuck, AT)
    begun = stuck.filter("task_id < 2").selectExpr("task_id", "0 step", "'mirror' stage")
    w.control.journal.write(begun, "m0", Journal.BEGUN, AT)
    ledger = spark.createDataFrame([], "table_name string, snapshot_id bigint, committed_at timestamp_ntz, partition_values map<string,string>")
    no_log = spark.createDataFrame([], "table_name string, snapshot_id bigint, mirrored_at timestamp_ntz")
    conduct.mirror_run(w.control, ledger, no_log, AT, "m1")
    left = w.control.queue.read().filter("shadow_status is not null").collect()
    # The journal knows nothing of the third: somebody else may be at it.
    assert [r.task_id for r in left] == [2]

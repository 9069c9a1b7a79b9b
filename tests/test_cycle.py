"""Two tables taken through the whole migration and back."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from carryall import vocabulary as v
from carryall.operators import catalog as cat
from carryall.operators import lifecycle, movement, selectors, sweep
from carryall.plans import runs
from carryall.plans.movement_queries import make_table
from carryall.schemas import CATALOG, JOB, KEY
from carryall.sources import appends, queue, tables

CATALOG_NAME, DB = "spark_catalog", "default"
N = v.DEFAULT
PARTS = ["date", "hour"]


def day(n):
    return f"2024-{3 + n // 28:02d}-{1 + n % 28:02d} 00:00:00"


class World:
    """The queue, the catalogue, the ledger and the real tables of a test."""

    def __init__(self, spark):
        self.spark = spark
        self.names = [tables.fresh_name("table") for _ in range(2)]
        entries = []
        for name in self.names:
            rows = spark.range(100).selectExpr(
                "cast(id as int) id", "concat('name_', id) name", "20230101 date", "cast(id % 3 as int) hour"
            )
            make_table(rows, name, PARTS, name=name)
            entries.append(self.entry(name))
        self.catalog = self.keep(spark.createDataFrame(entries, CATALOG), "catalog")
        self.jobs = spark.createDataFrame([], JOB)
        self.ledger = None
        self.log = None
        self.snapshot = 0

    def entry(self, name, **over):
        row = {f.name: None for f in CATALOG.fields} | {
            "catalog_name": CATALOG_NAME,
            "db_name": DB,
            "tbl_name": name,
            "table_type": "EXTERNAL_TABLE",
            "output_format": "x.MapredParquetOutputFormat",
            "data_uri": f"file:/{name}",
            "data_size": 100,
            "tags": ["do_not_rename", "do_not_drop"],
            "fields": [("id", "int"), ("name", "string"), ("date", "int"), ("hour", "int")],
        }
        return tuple((row | over).values())

    def keep(self, df, label):
        return tables.pin(df, label)

    def put(self, changes, at):
        self.jobs = self.keep(queue.upsert_jobs(self.jobs, changes.select(*JOB.fieldNames()), at), "jobs")

    def set_catalog(self, df):
        self.catalog = self.keep(df, "catalog")

    def edit(self, edits, physical=True):
        plan = self.keep(cat.rename_plan(edits, self.catalog), "plan")
        drops = self.keep(cat.drop_plan(edits, self.catalog), "drops")
        changed = cat.apply_edits(self.catalog, edits)
        self.set_catalog(changed)
        if physical:
            tables.run_drops(self.spark, drops)
            tables.run_renames(self.spark, plan)

    def states(self):
        rows = self.jobs.orderBy("tbl_name").collect()
        return {(r.to_be_processed, r.in_process, r.state, r.desired_state, r.migration_paused, r.pause_reason) for r in rows}

    def empty(self):
        return self.jobs.select(*KEY).limit(0)

    def write(self, name, rows, at):
        self.snapshot += 1
        new = appends.append_rows(rows, name, self.snapshot, at).withColumn(
            "table_name", F.lit(f"{CATALOG_NAME}/{DB}/{name}")
        )
        self.ledger = self.keep(new if self.ledger is None else self.ledger.unionByName(new), "ledger")

    # ---- components

    def preprocess(self, at):
        spark = self.spark
        no_meta = spark.createDataFrame([], "table_name string, category_tags map<string,string>")
        full = [f"{CATALOG_NAME}/{DB}/{n}" for n in self.names]
        contacts = spark.createDataFrame(
            [(f, ["owner@example.com"]) for f in full], "table_name string, contacts array<string>"
        )
        daily = spark.createDataFrame([], "table_name string, contacts array<string>, dateint int")
        events = spark.createDataFrame([], "table_name string, event_time timestamp, current_json string")
        lineage = spark.createDataFrame(
            [(f, "read", u) for f in full for u in ("ann", "ann@example.com", "bob", "owner")],
            "source_name string, operation string, user_id string",
        )
        changed, readers = runs.preprocess_plan(
            self.jobs, self.catalog, no_meta, contacts, daily, events, lineage, at, 20240229
        )
        folded = changed.select("task_id", F.explode("downstream_users").alias("downstream_user"))
        assert readers.exceptAll(folded).count() == 0
        self.put(changed, at)

    def notify(self, at):
        changed, mails = runs.notify_plan(self.jobs, self.catalog, self.empty(), at)
        got = mails.collect()
        self.put(changed, at)
        return got

    def migrate(self, at, strategy=None):
        planned = self.keep(runs.migrate_plan(self.jobs, self.catalog, self.empty(), at), "planned")
        for r in planned.orderBy("task_id").collect():
            name = tables.dotted(r.catalog_name, r.db_name, r.tbl_name)
            one = planned.filter(F.col("task_id") == r.task_id)
            for action in r.actions:
                if action == "lock":
                    self.set_catalog(cat.lock_tables(self.catalog, one))
                elif action == "copy":
                    target = tables.dotted(r.catalog_name, r.db_name, r.tbl_name + N.target_suffix)
                    where = tables.fresh_path(self.spark, "target")
                    movement.copy_table(self.spark, name, target, strategy or r.strategy, location=where)
                    new = self.entry(r.tbl_name + N.target_suffix, table_type="ICEBERG", tags=None)
                    self.set_catalog(self.catalog.unionByName(self.spark.createDataFrame([new], CATALOG)))
                elif action == "promote":
                    edits, rejects = cat.promote(one, self.catalog)
                    assert rejects.count() == 0
                    self.edit(edits)
                    defined, rejects = cat.copy_definition(one, self.catalog)
                    assert rejects.count() == 0
                    self.set_catalog(defined)
                elif action == "unlock":
                    self.set_catalog(cat.unlock_tables(self.catalog, one, production=True))
                elif action == "archive_source":
                    edits, rejects = cat.archive_source(one, self.catalog)
                    assert rejects.count() == 0
                    self.edit(edits)
        self.put(planned, at)
        return planned

    def count(self, name):
        return self.spark.table(name).count()


@pytest.fixture(params=["SNAPSHOT", "REWRITE"])
def strategy(request):
    return request.param


def test_full_cycle_then_swap_back(spark, strategy):
    w = World(spark)
    lines = spark.createDataFrame([(f"{CATALOG_NAME}/{DB}/{n}",) for n in w.names], "value string")
    new, rejects = queue.ingest_tables(lines, w.jobs, day(0))
    assert rejects.count() == 0
    w.jobs = w.keep(new, "jobs")
    w.jobs = w.keep(w.jobs.withColumn("probation_gap_days", F.lit(7)), "jobs")
    assert w.states() == {(0, 0, v.NEW, v.NEW, 0, "None")}

    w.preprocess(day(0))
    assert w.states() == {(1, 0, v.READY, v.LOCKED, 0, "None")}
    first = w.jobs.first()
    assert first.tbl_owners == ["owner@example.com"]
    assert first.downstream_users == ["ann@example.com", "bob@example.com", "owner@example.com"]

    mails = w.notify(day(0))
    assert sorted((m.level, m.audience) for m in mails) == [(1, "owner"), (1, "readers"), (1, "readers")]
    assert w.notify(day(0)) == []

    # The notice period is not over before the fifteenth day.
    assert w.migrate(day(14)).count() == 0
    assert w.migrate(day(15), strategy).count() == 2
    assert w.states() == {(0, 1, v.OPEN, v.OPEN, 0, "None")}
    for name in w.names:
        assert (w.count(name), w.count(name + "_source")) == (100, 100)
        source = w.catalog.filter(F.col("tbl_name") == name + "_source").first()
        assert source.tags == ["archived_source", "do_not_drop", "do_not_rename"]
        target = w.catalog.filter(F.col("tbl_name") == name).first()
        assert "migrated_from_source" in target.tags and target.secure
        assert target.migrated_data_location == f"file:/{name}"

    # Probation: the new table is written to, the old one follows.
    for name in w.names:
        rows = spark.range(100, 200).selectExpr(
            "cast(id as int) id", "concat('name_', id) name", "20230102 date", "cast(id % 5 as int) hour"
        )
        w.write(name, rows, day(16))
        assert (w.count(name), w.count(name + "_source")) == (200, 100)
    no_log = spark.createDataFrame([], "table_name string, snapshot_id bigint, mirrored_at timestamp_ntz")
    seen = []
    log, steps = sweep.mirror_sweep(
        spark, w.jobs, w.ledger, no_log, day(16), on_status=lambda task, status: seen.append((task, status))
    )
    assert [r.outcome for r in steps.collect()] == ["mirrored"] * 2
    for task in {task for task, _ in seen}:
        assert [s for t, s in seen if t == task] == [v.MIRRORING, None]
    assert len(seen) == 4
    w.log = w.keep(log, "log")
    for name in w.names:
        left, right = spark.table(name), spark.table(name + "_source")
        assert right.count() == 200 and movement.content_difference(left, right.select(*left.columns)).count() == 0
    idle, _ = sweep.mirror_sweep(spark, w.jobs, w.ledger, w.log, day(16))
    assert idle.count() == 0

    assert sorted(m.level for m in w.notify(day(17))) == [2, 2]
    w.preprocess(day(20))
    assert w.states() == {(0, 1, v.OPEN, v.OPEN, 0, "None")}
    w.preprocess(day(25))
    assert w.states() == {(0, 1, v.OPEN, v.SOURCE_ARCHIVED, 0, "None")}
    assert {tuple(r.actions) for r in w.migrate(day(25)).collect()} == {("archive_source",)}
    assert w.states() == {(0, 1, v.SOURCE_ARCHIVED, v.SOURCE_ARCHIVED, 0, "None")}
    for name in w.names:
        assert w.count(name + "_source_archived") == 200
    w.preprocess(day(26))
    assert w.states() == {(0, 0, v.SOURCE_ARCHIVED, v.SOURCE_ARCHIVED, 0, "None")}
    assert sorted(m.level for m in w.notify(day(27))) == [3, 3]
    assert w.notify(day(27)) == []

    # And back: the archived sources take their names again.
    edits, outcome = cat.swap_back_finalized(w.jobs, w.catalog)
    outcome = w.keep(outcome, "outcome")
    w.edit(edits)
    w.put(lifecycle.revert_finalized_step(w.jobs, outcome), day(28))
    assert w.states() == {(1, 0, v.READY, v.LOCKED, 1, v.REVERTED)}
    for name in w.names:
        assert w.count(name) == 200 and w.count(name + "_target_archived") == 200
        assert w.catalog.filter(F.col("tbl_name") == name).first().table_type == "EXTERNAL_TABLE"
    again, outcome = cat.swap_back_finalized(w.jobs, w.catalog)
    assert again.count() == 0 and {r.reason for r in outcome.collect()} == {"already in source format"}


def test_revert_in_probation(spark):
    w = World(spark)
    name = w.names[0]
    lines = spark.createDataFrame([(f"{CATALOG_NAME}/{DB}/{name}",)], "value string")
    w.jobs = w.keep(queue.ingest_tables(lines, w.jobs, day(0))[0].withColumn("probation_gap_days", F.lit(7)), "jobs")
    w.preprocess(day(0))
    w.notify(day(0))
    w.migrate(day(15))
    rows = spark.range(3).selectExpr("cast(id as int) id", "'late' name", "20230103 date", "1 hour")
    w.write(name, rows, day(16))

    asked, _ = queue.read_table_list(
        spark.createDataFrame([(f" {CATALOG_NAME.upper()}.{DB}.{name}",), ("no.such.table",)], "value string")
    )
    from carryall.operators.enrich import classify_kind

    picked, rejects = selectors.select_revert(classify_kind(w.jobs, w.catalog), asked)
    assert [r.reason for r in rejects.collect()] == ["unknown table"]
    planned = w.keep(lifecycle.revert_step(picked), "revert")
    assert planned.first().actions == ["lock", "mirror_back", "restore", "unlock", "retire_target"]
    for action in planned.first().actions:
        if action == "lock":
            w.set_catalog(cat.lock_tables(w.catalog, planned))
        elif action == "mirror_back":
            movement.mirror_updates(spark, name, name + "_source", day(17))
        elif action in ("restore", "retire_target"):
            edits, rejects = getattr(cat, action)(planned, w.catalog)
            assert rejects.count() == 0
            w.edit(edits)
        elif action == "unlock":
            w.set_catalog(cat.unlock_tables(w.catalog, planned))
    w.put(planned, day(17))
    assert w.states() == {(0, 1, v.TARGET_RETIRED, v.TARGET_RETIRED, 1, v.REVERTED)}
    assert w.count(name) == 103 and w.count(name + "_target_revert") == 103
    assert w.catalog.filter(F.col("tbl_name") == name).first().table_type == "EXTERNAL_TABLE"


def test_skip_rules_at_each_stage(spark):
    w = World(spark)
    moved, text, gone = w.names[0], w.names[1], "this_table_does_not_exist"
    rows = [
        w.entry(moved, table_type="ICEBERG"),
        w.entry(text, output_format="x.TextOutputFormat"),
    ]
    w.catalog = w.keep(spark.createDataFrame(rows, CATALOG), "catalog")
    lines = spark.createDataFrame([(f"{CATALOG_NAME}/{DB}/{n}",) for n in (moved, text, gone)], "value string")
    start = w.keep(queue.ingest_tables(lines, w.jobs, day(0))[0], "jobs")

    def reasons():
        return {r.tbl_name: (r.migration_paused, r.pause_reason) for r in w.jobs.collect()}

    w.jobs = start
    w.preprocess(day(0))
    assert reasons() == {moved: (1, v.ALREADY_TARGET), text: (0, "None"), gone: (1, v.TABLE_NOT_FOUND)}

    ready = {"to_be_processed": F.lit(1), "state": F.lit(v.READY), "desired_state": F.lit(v.LOCKED), "stg_format": F.lit(v.TEXT)}
    want = {moved: (1, v.ALREADY_TARGET), text: (1, v.TEXT_FORMAT), gone: (1, v.TABLE_NOT_FOUND)}
    w.jobs = w.keep(start.withColumns(ready), "jobs")
    assert w.notify(day(1)) == []
    assert reasons() == want

    w.jobs = w.keep(
        start.withColumns(ready | {"comm_level1_date": F.lit(day(0)).cast("timestamp_ntz")}), "jobs"
    )
    assert {tuple(r.actions) for r in w.migrate(day(20)).collect()} == {()}
    assert reasons() == want

    # The state is kept when the table turns out to be moved only at the copy.
    w.jobs = w.keep(
        start.withColumns(ready | {"to_be_processed": F.lit(0), "in_process": F.lit(1)}).filter(F.col("tbl_name") == moved),
        "jobs",
    )
    assert w.migrate(day(20)).first().actions == ["lock", "refuse_copy"]
    assert w.states() == {(0, 1, v.READY, v.LOCKED, 1, v.ALREADY_TARGET)}

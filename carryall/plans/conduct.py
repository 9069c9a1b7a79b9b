"""Runs that carry their decisions out, and go on where they were cut off.

A run decides for all its jobs at once, and then takes them through their stages wave by
wave: the next action of every job, as one edit of the catalogue and, where real tables
are concerned, as many pieces of work as there are jobs, each apart from the others.
Before a wave the journal says what is begun, after it what came of it; then catalogue
and queue are replaced. A job that fails stays where it was and leaves the run.

Run again under the same id, a run takes up every job at the state the queue has for it.
A stage that the journal has as done, but that did not reach the queue, is not carried out
again; one that was cut off is, as each can be repeated: copies are built aside, renames
already made are passed over, mirrors change nothing twice.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from carryall import vocabulary as v
from carryall.operators import catalog as cat
from carryall.operators import enrich, lifecycle, movement, selectors, sweep
from carryall.plans import runs
from carryall.schemas import JOB_COLUMNS, KEY
from carryall.sources import queue
from carryall.sources.pool import WIDTH, each
from carryall.sources.store import Journal, StoredTable
from carryall.sources.tables import dotted, fresh_path, pin, rename_in_turn

# Stages that come before the first action of a flow.
UNARCHIVE, SWAP_BACK = "unarchive_source", "swap_back"
_RENAMING = ("promote", "restore", "archive_source", "retire_target")
_MOST_WAVES = 8
_RESULT = "task_id bigint, detail string, location string"


@dataclass
class Control:
    """The control tables of a deployment, and how its tables are spelled and placed."""

    spark: SparkSession
    queue: StoredTable
    catalog: StoredTable
    journal: Journal
    names: v.Naming = v.DEFAULT
    spell: Callable[[str, str, str], str] = dotted
    place: Callable[[SparkSession], str] = field(default=lambda spark: fresh_path(spark, "target"))
    records: StoredTable | None = None
    production: bool = False
    width: int = WIDTH

    def put(self, jobs: DataFrame, as_of) -> None:
        self.queue.replace(queue.upsert_jobs(self.queue.read(), jobs.select(*JOB_COLUMNS), as_of))


# ---------------------------------------------------------------- real tables


def _physical(control: Control, jobs: DataFrame, work, label: str) -> DataFrame:
    """Calls ``work(session, job)`` for every job apart: task_id, detail (the error), location."""
    rows = []
    for job, value, error in each(control.spark, jobs.toLocalIterator(), work, control.width, label):
        rows.append((job["task_id"], error, value))
    return control.spark.createDataFrame(rows, _RESULT)


def _copy(control: Control, jobs: DataFrame) -> DataFrame:
    def work(session, job):
        key = job["catalog_name"], job["db_name"]
        location = control.place(session)
        src = control.spell(*key, job["tbl_name"])
        dst = control.spell(*key, job["tbl_name"] + control.names.target_suffix)
        movement.copy_table(session, src, dst, job["strategy"], location)
        return location

    return _physical(control, jobs.select("task_id", *KEY, "strategy"), work, "copy")


def _mirror_back(control: Control, jobs: DataFrame) -> DataFrame:
    def work(session, job):
        key = job["catalog_name"], job["db_name"]
        src = control.spell(*key, job["tbl_name"])
        movement.bring_up(session, src, control.spell(*key, job["tbl_name"] + control.names.source_suffix), None)

    return _physical(control, jobs.select("task_id", *KEY), work, "mirror")


def _rename(control: Control, jobs: DataFrame, edits: DataFrame) -> DataFrame:
    """Drops and renames of every job; a job without any has nothing to do."""
    steps = cat.physical_steps(edits).withColumnRenamed("base", "tbl_name")

    def work(session, job):
        def spelled(name):
            return control.spell(job["catalog_name"], job["db_name"], name)

        moves = {r["tbl_name"]: r["new_name"] for r in job["renames"] or ()}
        # What is in the way goes first; once a rename is made, its name may be another's.
        if all(session.catalog.tableExists(spelled(old)) for old in moves):
            for name in job["drops"] or ():
                session.sql(f"DROP TABLE IF EXISTS {spelled(name)}")
        rename_in_turn(session, [(spelled(old), spelled(new)) for old, new in moves.items()])

    return _physical(control, jobs.select("task_id", *KEY).join(steps, KEY, "left"), work, "rename")


# ---------------------------------------------------------------- waves


def _done_before(control: Control, run_id: str) -> DataFrame | None:
    """task_id, action of the stages that an earlier try of the run has done; None if there are none.

    A stage occurs once in a flow; a resumed run may come to it in another wave.
    """
    stages = control.journal.stages(run_id).filter(F.col("outcome") == Journal.DONE)
    done = pin(stages.select("task_id", F.col("stage").alias("action"), F.col("detail").alias("location")), "before")
    return None if done.isEmpty() else done


def _carry_out(
    control: Control, run_id: str, as_of, step: int, acting: DataFrame, kinds: list[str], before: DataFrame | None
) -> DataFrame:
    """One wave over acting(job columns, strategy, action): the jobs that came through.

    Journal, real tables, journal, catalogue: in this order, the queue being the caller's.
    """
    entry = acting.select("task_id", F.lit(step).alias("step"), F.col("action").alias("stage"))
    control.journal.write(entry, run_id, Journal.BEGUN, as_of)
    todo, done = acting, None
    if before is not None:
        todo = pin(acting.join(before, ["task_id", "action"], "left_anti"), "todo")
        done = acting.join(before, ["task_id", "action"])
    catalog = control.catalog.read()
    results = control.spark.createDataFrame([], _RESULT)
    edits: dict[str, DataFrame] = {}
    for kind in kinds:
        jobs = todo.filter(F.col("action") == kind)
        everyone = acting.filter(F.col("action") == kind)
        if kind in (*_RENAMING, UNARCHIVE):
            operation = cat.unarchive_source if kind == UNARCHIVE else getattr(cat, kind)
            changes, rejects = operation(everyone, catalog, control.names)
            edits[kind] = pin(changes, "edits")
            refused = jobs.join(rejects, KEY).select("task_id", F.col("reason").alias("detail"), F.lit(None).cast("string").alias("location"))
            refused = pin(refused, "refused")
            fine = jobs.join(refused.select("task_id"), "task_id", "left_anti")
            results = results.unionByName(refused).unionByName(_rename(control, fine, edits[kind]))
        elif kind == "copy":
            results = results.unionByName(_copy(control, jobs))
        elif kind == "mirror_back":
            results = results.unionByName(_mirror_back(control, jobs))
        else:
            results = results.unionByName(jobs.select("task_id", F.lit(None).cast("string").alias("detail"), F.lit(None).cast("string").alias("location")))
    results = pin(results, "results")
    ended = entry.join(results, "task_id").select("task_id", "step", "stage", "detail", F.when(F.col("detail").isNull(), Journal.DONE).otherwise(Journal.FAILED).alias("outcome"), "location")
    # Where a copy went is kept with it: a rerun needs it for the catalogue.
    said = ended.withColumn("detail", F.coalesce("detail", "location")).drop("location")
    control.journal.write(said, run_id, None, as_of)
    passed = todo.join(results.filter("detail is null").select("task_id", "location"), "task_id")
    passed = pin(passed if done is None else passed.unionByName(done), "passed")
    _edit_catalog(control, kinds, passed, edits)
    return passed.drop("location")


def _edit_catalog(control: Control, kinds: list[str], passed: DataFrame, edits) -> None:
    """The catalogue after a wave: the edits of the jobs that came through."""
    catalog, names = control.catalog.read(), control.names
    every = None
    for kind in kinds:
        jobs = passed.filter(F.col("action") == kind)
        if kind == "lock":
            some = cat.lock_edits(jobs, names)
        elif kind == "unlock":
            some = cat.unlock_edits(jobs, names, control.production)
        elif kind in edits:
            keys = jobs.select(KEY[0], KEY[1], F.col(KEY[2]).alias("base"))
            some = edits[kind].join(keys, [KEY[0], KEY[1], "base"], "left_semi").select(*edits[kind].columns)
        else:
            continue
        every = some if every is None else every.unionByName(some)
    if every is not None:
        catalog = cat.apply_edits(catalog, every)
    if "copy" in kinds:
        catalog = cat.target_entries(passed.filter("action = 'copy'"), catalog, names)
    if "promote" in kinds:
        promoted = passed.filter("action = 'promote'")
        catalog, _ = cat.copy_definition(promoted, catalog, names)
        if control.records is not None:
            control.records.replace(cat.copy_classification(promoted, control.records.read(), names))
    control.catalog.replace(catalog)


def _walk(
    control: Control, run_id: str, as_of, jobs: DataFrame, flow: str, before: DataFrame | None
) -> None:
    """Takes jobs(job columns, strategy, is_source) to rest, one wave of actions at a time."""
    columns = jobs.columns
    jobs = pin(jobs, "walking")
    for step in range(1, _MOST_WAVES):
        acting = lifecycle.next_action(jobs, flow).filter("action is not null")
        # A table in target format already is not copied: the job goes back and pauses.
        refused = (F.col("action") == "copy") & ~F.coalesce(F.col("is_source"), F.lit(False))
        kinds = [tuple(r) for r in acting.select("action", refused.alias("refused")).distinct().collect()]
        if not kinds:
            return
        if any(r for _, r in kinds):
            back = {
                "state": F.lit(v.READY),
                "desired_state": F.lit(v.LOCKED),
                "migration_paused": F.lit(1),
                "pause_reason": F.lit(v.ALREADY_TARGET),
            }
            control.put(acting.filter(refused).withColumns(back), as_of)
            acting = acting.filter(~refused)
        going = sorted(kind for kind, r in kinds if not r)
        if not going:
            return
        passed = _carry_out(control, run_id, as_of, step, acting, going, before)
        jobs = passed.withColumns({"state": F.col("next_state"), "desired_state": F.col("next_desired")}).select(*columns)
        control.put(jobs, as_of)


# ---------------------------------------------------------------- runs


def migrate_run(
    control: Control,
    empty: DataFrame,
    as_of,
    run_id: str,
    batches: DataFrame | None = None,
    batch_id: str | None = None,
    shard: tuple[int, int] | None = None,
    allow_text: bool = False,
) -> DataFrame:
    """Migrates all due jobs; gives the stages of the run with their outcomes.

    Jobs held at the gate are paused in the queue and have no stage. The locations of new
    targets are in the detail of their copies.
    """
    catalog = control.catalog.read()
    planned = runs.migrate_plan(
        control.queue.read(), catalog, empty, as_of, control.names, batches, batch_id, shard, allow_text
    )
    planned = pin(planned, "planned")
    # The plan has the end states; the walk starts from where the queue has the jobs.
    now = control.queue.read().select("task_id", F.col("state").alias("__s"), F.col("desired_state").alias("__d"))
    held = F.col("gate") == "hold"
    # A copy refused at the end of the plan is refused in its wave.
    refused = F.array_contains("actions", lifecycle.REFUSE_COPY)
    start = planned.join(now, "task_id").withColumns(
        {
            "state": F.col("__s"),
            "desired_state": F.col("__d"),
            "migration_paused": F.when(held, F.col("migration_paused")).otherwise(F.lit(0)),
            "pause_reason": F.when(refused, F.lit(v.NOT_PAUSED)).otherwise(F.col("pause_reason")),
            "run_id": F.lit(run_id),
        }
    )
    start = pin(start.drop("__s", "__d"), "start")
    control.put(start, as_of)
    _walk(control, run_id, as_of, start.filter(~held), v.FORWARD, _done_before(control, run_id))
    return control.journal.stages(run_id)


def revert_run(control: Control, asked: DataFrame, as_of, run_id: str) -> tuple[DataFrame, DataFrame]:
    """Reverts the jobs of the tables asked(key) for: (stages of the run, rejects).

    Archived sources get the kept name back first; what was written to the target since is
    mirrored back, the source takes its name again, and the target is set aside.
    """
    stages = pin(control.journal.stages(run_id), "stages")
    known = stages.select("task_id").distinct()
    jobs = enrich.classify_kind(control.queue.read(), control.catalog.read(), control.names)
    open_jobs = jobs.join(known, "task_id", "left_anti")
    pending = asked.join(jobs.join(known, "task_id").select(*KEY), KEY, "left_anti")
    picked, rejects = selectors.select_revert(open_jobs, pending)
    rejects = pin(rejects, "rejects")
    fresh = picked.select(*JOB_COLUMNS).withColumns(
        {
            "migration_paused": F.lit(1),
            "pause_reason": F.lit(v.REVERTED),
            "state": F.lit(v.OPEN),
            "desired_state": F.lit(v.LOCKED),
            "run_id": F.lit(run_id),
        }
    )
    again = control.queue.read().join(known, "task_id", "left_semi")
    jobs = pin(fresh.unionByName(again.select(*JOB_COLUMNS)), "reverted")
    control.put(jobs, as_of)
    extra = {"strategy": F.lit("REWRITE"), "is_source": F.lit(True)}
    begun = jobs.withColumns({**extra, "action": F.lit(UNARCHIVE)})
    before = _done_before(control, run_id)
    ended = stages.filter((F.col("stage") != UNARCHIVE) & (F.col("outcome") == Journal.DONE)).select("task_id").distinct()
    later = jobs.join(ended, "task_id", "left_semi")
    first = begun.join(ended, "task_id", "left_anti")
    passed = _carry_out(control, run_id, as_of, 0, pin(first, "begun"), [UNARCHIVE], before)
    walking = passed.select(*JOB_COLUMNS).unionByName(later.select(*JOB_COLUMNS))
    _walk(control, run_id, as_of, walking.withColumns(extra), v.REVERT, before)
    return control.journal.stages(run_id), rejects


def revert_finalized_run(control: Control, asked: DataFrame, as_of, run_id: str) -> tuple[DataFrame, DataFrame]:
    """Swaps finished migrations back: (stages of the run, outcome of every table asked for).

    Archived sources take their tables' names, the targets go to their archive name; the
    jobs are queued again, paused. A swap that the journal has as done is only finished.
    """
    jobs = pin(control.queue.read().join(asked.select(*KEY).distinct(), KEY, "left_semi").select(*JOB_COLUMNS), "asked")
    catalog = control.catalog.read()
    edits, outcome = cat.swap_back_finalized(jobs, catalog, control.names)
    edits, outcome = pin(edits, "edits"), pin(outcome, "outcome")
    stages = control.journal.stages(run_id).filter(F.col("outcome") == Journal.DONE).select("task_id")
    before = pin(jobs.join(stages, "task_id", "left_semi"), "before")
    fine = jobs.join(outcome.filter("swapped").select(*KEY), KEY, "left_semi").join(before.select("task_id"), "task_id", "left_anti")
    fine = pin(fine, "swapping")
    entry = fine.select("task_id", F.lit(0).alias("step"), F.lit(SWAP_BACK).alias("stage"))
    control.journal.write(entry, run_id, Journal.BEGUN, as_of)
    results = pin(_rename(control, fine, edits), "results")
    state = F.when(F.col("detail").isNull(), Journal.DONE).otherwise(Journal.FAILED)
    control.journal.write(entry.join(results, "task_id").withColumn("outcome", state).drop("location"), run_id, None, as_of)
    done = fine.join(results.filter("detail is null").select("task_id"), "task_id", "left_semi").unionByName(before)
    done = pin(done, "swapped")
    keys = done.select(KEY[0], KEY[1], F.col(KEY[2]).alias("base"))
    control.catalog.replace(cat.apply_edits(catalog, edits.join(keys, [KEY[0], KEY[1], "base"], "left_semi")))
    swapped = done.select(*KEY, F.lit(True).alias("swapped"))
    control.put(lifecycle.revert_finalized_step(control.queue.read(), swapped), as_of)
    done_keys = done.select(*KEY, F.lit(True).alias("__done"))
    told = outcome.join(done_keys, KEY, "left").select(
        *KEY, F.coalesce("__done", F.lit(False)).alias("swapped"), F.when(F.col("__done").isNull(), F.col("reason")).alias("reason")
    )
    return control.journal.stages(run_id), told


def mirror_run(
    control: Control, ledger: DataFrame, mirror_log: DataFrame, as_of, run_id: str, verify: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Mirrors all due jobs: (mirror-log rows to add, outcomes), the status kept in the queue.

    All due jobs are marked as being mirrored in one write, and cleared in one write when
    the sweep is over, failed ones too. A job that a run left marked because it was cut
    off is taken up by the next: the journal has no end for it.
    """
    journal = control.journal
    rows = journal.read().filter("stage = 'mirror'")
    ended = rows.filter(F.col("outcome") != Journal.BEGUN).select("run_id", "task_id")
    cut_off = rows.filter(F.col("outcome") == Journal.BEGUN).join(ended, ["run_id", "task_id"], "left_anti").select("task_id").distinct()
    jobs = control.queue.read()
    stuck = F.col("shadow_status") == v.MIRRORING
    taken_up = jobs.filter(stuck).join(cut_off, "task_id", "left_semi").withColumn("shadow_status", F.lit(None).cast("string"))
    jobs = pin(jobs.join(taken_up.select("task_id"), "task_id", "left_anti").unionByName(taken_up), "jobs")
    due = pin(selectors.select_mirror(jobs), "due").withColumn("run_id", F.lit(run_id))
    entry = due.select("task_id", F.lit(0).alias("step"), F.lit("mirror").alias("stage"))
    journal.write(entry, run_id, Journal.BEGUN, as_of)
    control.put(due.withColumn("shadow_status", F.lit(v.MIRRORING)), as_of)
    log, outcomes = sweep.mirror_sweep(
        control.spark, due, ledger, mirror_log, as_of, control.names, verify, None, control.spell, control.width
    )
    log, outcomes = pin(log, "log"), pin(outcomes, "outcomes")
    failed = outcomes.filter(F.col("outcome") == sweep.FAILED).select("task_id", F.col("error").alias("detail"))
    ends = entry.join(failed, "task_id", "left")
    state = F.when(F.col("detail").isNull(), Journal.DONE).otherwise(Journal.FAILED)
    journal.write(ends.withColumn("outcome", state), run_id, None, as_of)
    control.put(due.withColumn("shadow_status", F.lit(None).cast("string")), as_of)
    return log, outcomes

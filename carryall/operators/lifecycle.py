"""State decisions for whole sets of jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from carryall import vocabulary as v
from carryall.functions import sets
from carryall.functions.names import qualified
from carryall.operators.catalog import table_family
from carryall.operators.enrich import (
    data_category,
    mark_empty,
    source_format,
    storage_format,
    timestamp_columns,
)
from carryall.schemas import KEY

# Fixed value: the action recorded when a copy finds the table already moved.
REFUSE_COPY = "refuse_copy"


def _at(state: str, desired: str) -> Column:
    return (F.col("state") == state) & (F.col("desired_state") == desired)


def preprocess_step(
    jobs: DataFrame,
    catalog: DataFrame,
    metadata: DataFrame,
    owners: DataFrame,
    reader_sets: DataFrame,
    names: v.Naming = v.DEFAULT,
) -> DataFrame:
    """Next version of the selected jobs: enrich new ones, move resting ones on.

    metadata(table_name, category_tags), owners(table_name, owners) and
    reader_sets(table_name, downstream_users) hold a table at most once. All
    joins use the qualified name, so the jobs are shuffled once.
    """
    name = F.col("__name")
    facts = catalog.select(
        qualified("/").alias("__name"),
        source_format(names).alias("__src"),
        storage_format(F.col("output_format")).alias("__fmt"),
    )
    known = metadata.select(F.col("table_name").alias("__name"), "category_tags")
    held = owners.select(F.col("table_name").alias("__name"), F.col("owners").alias("__owners"))
    read = reader_sets.select(
        F.col("table_name").alias("__name"), F.col("downstream_users").alias("__readers")
    )
    rows = (
        jobs.withColumn("__name", qualified("/"))
        .join(facts, "__name", "left")
        .join(known, "__name", "left")
        .join(held, "__name", "left")
        .join(read, "__name", "left")
    )
    fresh = (F.col("to_be_processed") == 0) & (F.col("in_process") == 0) & _at(v.NEW, v.NEW)
    missing = fresh & F.col("__src").isNull()
    found = fresh & F.col("__src").isNotNull()
    ready = found & F.col("__src")
    moved = found & ~F.col("__src")
    probation_over = (F.col("in_process") == 1) & _at(v.OPEN, v.OPEN)
    archived = (F.col("in_process") == 1) & _at(v.SOURCE_ARCHIVED, v.SOURCE_ARCHIVED)

    def fill(name, value):
        empty = found & sets.is_blank(F.col(name))
        return F.when(empty, F.coalesce(value, sets.empty_set())).otherwise(F.col(name))

    new = {
        "stg_format": F.when(found, F.col("__fmt")).otherwise(F.col("stg_format")),
        "data_category": F.when(found, data_category(F.col("category_tags"))).otherwise(
            F.col("data_category")
        ),
        "tbl_owners": fill("tbl_owners", F.col("__owners")),
        "downstream_users": fill("downstream_users", F.col("__readers")),
        "to_be_processed": F.when(ready, 1).otherwise(F.col("to_be_processed")),
        "in_process": F.when(archived, 0).otherwise(F.col("in_process")),
        "state": F.when(ready, v.READY).otherwise(F.col("state")),
        "desired_state": F.when(ready, v.LOCKED)
        .when(probation_over, v.SOURCE_ARCHIVED)
        .otherwise(F.col("desired_state")),
        "migration_paused": F.when(missing | moved, 1).otherwise(F.col("migration_paused")),
        "pause_reason": F.when(missing, v.TABLE_NOT_FOUND)
        .when(moved, v.ALREADY_TARGET)
        .otherwise(F.col("pause_reason")),
    }
    return rows.select(*[new.get(c, F.col(c)).alias(c) for c in jobs.columns])


def migrate_gate(
    jobs: DataFrame,
    catalog: DataFrame,
    empty: DataFrame | None = None,
    names: v.Naming = v.DEFAULT,
    allow_text: bool = False,
) -> DataFrame:
    """Next version of jobs about to be migrated, with gate = go / hold.

    ``empty`` holds the keys of empty source tables, unless the jobs have an
    ``is_empty`` column. A job goes on unless it was
    paused here; ``allow_text`` lets tables in other formats through to a rewrite.
    """
    family = table_family(
        catalog,
        {"__base": "", "__kept": names.source_suffix},
        source_format(names).alias("src"),
    )
    rows = mark_empty(jobs, empty).join(family, KEY, "left")
    missing = F.col("__base").isNull() & F.col("__kept").isNull()
    source = F.coalesce(F.col("__base.src"), F.lit(False))
    copyable = (
        F.coalesce(F.col("stg_format") == v.PARQUET, F.lit(False))
        | F.col("is_empty")
        | F.lit(allow_text)
    )
    starting = ~missing & (F.col("to_be_processed") == 1)
    go = starting & source & copyable
    text = starting & source & ~copyable
    moved = starting & ~source
    hold = missing | text | moved
    new = {
        "in_process": F.when(go, 1).otherwise(F.col("in_process")),
        "to_be_processed": F.when(go, 0).otherwise(F.col("to_be_processed")),
        "migration_paused": F.when(hold, 1).otherwise(F.col("migration_paused")),
        "pause_reason": F.when(missing, v.TABLE_NOT_FOUND)
        .when(text, v.TEXT_FORMAT)
        .when(moved, v.ALREADY_TARGET)
        .otherwise(F.col("pause_reason")),
    }
    return rows.select(
        *[new.get(c, F.col(c)).alias(c) for c in jobs.columns],
        F.when(hold, "hold").otherwise("go").alias("gate"),
        source.alias("is_source"),
    )


def copy_strategy(
    jobs: DataFrame,
    catalog: DataFrame,
    empty: DataFrame | None = None,
    names: v.Naming = v.DEFAULT,
) -> DataFrame:
    """Adds strategy SNAPSHOT or REWRITE; a rewrite marks the job as csv/text.

    A table is snapshotted when it is parquet, has no timestamp column and sits
    in an ordinary database, or when it is empty.
    """
    facts = catalog.select(*KEY, timestamp_columns(F.col("fields")).alias("__ts"))
    rows = mark_empty(jobs, empty).join(facts, KEY, "left")
    special = F.lit(False)
    for prefix in names.rewrite_db_prefixes:
        special = special | F.startswith(F.col("db_name"), F.lit(prefix))
    plain = (
        (F.col("stg_format") == v.PARQUET) & ~special & ~F.coalesce("__ts", F.lit(False))
    )
    snapshot = F.coalesce(plain, F.lit(False)) | F.col("is_empty")
    kept = [c for c in jobs.columns if c != "stg_format"]
    return rows.select(
        *kept,
        F.when(snapshot, F.col("stg_format")).otherwise(v.TEXT).alias("stg_format"),
        F.when(snapshot, "SNAPSHOT").otherwise("REWRITE").alias("strategy"),
    )


def transitions(spark: SparkSession) -> DataFrame:
    """(state, desired_state, flow, action, next_state, next_desired): 20 fixed rows."""
    rows = []
    for state, desired, action, forward, revert in v.TRANSITIONS:
        rows.append((state, desired, v.FORWARD, action, *forward))
        rows.append((state, desired, v.REVERT, action, *revert))
    return spark.createDataFrame(
        rows,
        "state string, desired_state string, flow string, action string, "
        "next_state string, next_desired string",
    )


def next_action(jobs: DataFrame, flow: str = v.FORWARD) -> DataFrame:
    """Adds action, next_state and next_desired; a job at rest has none."""
    moves = transitions(jobs.sparkSession).filter(F.col("flow") == flow).drop("flow")
    return jobs.join(F.broadcast(moves), ["state", "desired_state"], "left").select(
        *jobs.columns, "action", "next_state", "next_desired"
    )


def journeys(spark: SparkSession, flow: str) -> DataFrame:
    """Every start pair with the actions up to rest: one fixed row per pair and case.

    ``blocked`` is the case of a table that is already in the target format: its
    copy is refused and the job goes back to the start, paused.
    """
    moves = {}
    for state, desired, action, forward, revert in v.TRANSITIONS:
        moves[(state, desired)] = (action, forward if flow == v.FORWARD else revert)
    rows = []
    for start in moves:
        for blocked in (False, True):
            here, actions, refused = start, [], False
            while here in moves and not refused:
                action, after = moves[here]
                refused = blocked and action == "copy"
                actions.append(REFUSE_COPY if refused else action)
                here = (v.READY, v.LOCKED) if refused else after
            rows.append((*start, blocked, actions, *here, refused))
    return spark.createDataFrame(
        rows,
        "state string, desired_state string, blocked boolean, actions array<string>, "
        "end_state string, end_desired string, refused boolean",
    )


def advance_jobs(
    jobs: DataFrame, flow: str = v.FORWARD, only: Column | None = None
) -> DataFrame:
    """Jobs walked to rest, with the ordered ``actions`` this takes.

    A job whose ``is_source`` column (optional) is false has its copy refused:
    it is paused and reset. Jobs that fail the condition ``only`` stay where they
    are. The walk of each start pair is a row of a small fixed table, so any
    number of jobs takes one broadcast join and no loop.
    """
    walk = journeys(jobs.sparkSession, flow)
    blocked = ~F.col("is_source") if "is_source" in jobs.columns else F.lit(False)
    go = F.lit(True) if only is None else F.coalesce(only, F.lit(False))
    rows = jobs.withColumns(
        {"blocked": F.coalesce(blocked, F.lit(True)), "go": go}
    ).join(
        F.broadcast(walk.withColumn("go", F.lit(True))),
        ["state", "desired_state", "blocked", "go"],
        "left",
    )
    refused = F.coalesce("refused", F.lit(False))
    new = {
        "state": F.coalesce("end_state", "state"),
        "desired_state": F.coalesce("end_desired", "desired_state"),
        "migration_paused": F.when(refused, 1).otherwise(F.col("migration_paused")),
        "pause_reason": F.when(refused, v.ALREADY_TARGET).otherwise(F.col("pause_reason")),
    }
    return rows.select(
        *[new.get(c, F.col(c)).alias(c) for c in jobs.columns],
        F.coalesce("actions", sets.empty_set()).alias("actions"),
    )


def revert_step(jobs: DataFrame) -> DataFrame:
    """Jobs to revert: paused, set to the start of the way back, and walked."""
    return advance_jobs(
        jobs.withColumns(
            {
                "migration_paused": F.lit(1),
                "pause_reason": F.lit(v.REVERTED),
                "state": F.lit(v.OPEN),
                "desired_state": F.lit(v.LOCKED),
            }
        ),
        v.REVERT,
    )


def revert_finalized_step(jobs: DataFrame, swapped: DataFrame) -> DataFrame:
    """Jobs whose finished table was swapped back: queued again, but paused.

    ``swapped`` is the outcome of the swap with a boolean column of that name.
    """
    done = swapped.filter("swapped").select(*KEY)
    return jobs.join(done, KEY, "left_semi").withColumns(
        {
            "to_be_processed": F.lit(1),
            "in_process": F.lit(0),
            "state": F.lit(v.READY),
            "desired_state": F.lit(v.LOCKED),
            "migration_paused": F.lit(1),
            "pause_reason": F.lit(v.REVERTED),
        }
    )

"""Which jobs are due: queue filters for every stage of the migration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from carryall import vocabulary as v
from carryall.functions.names import qualified
from carryall.functions.shards import shard_of
from carryall.functions.times import days, moment
from carryall.schemas import KEY


def _active() -> Column:
    return F.col("migration_paused") == 0


def _at_rest(state: str) -> Column:
    return (F.col("state") == state) & (F.col("desired_state") == state)


def _flag(name: str, value: int) -> Column:
    return F.col(name) == value


def select_preprocess(
    jobs: DataFrame,
    as_of,
    limit: int | None = None,
    shard: tuple[int, int] | None = None,
) -> DataFrame:
    """Jobs to enrich or to move on to the archive stage.

    ``shard`` = (index, count) picks one worker's share first; ``limit`` then
    takes the lowest task ids, so no shard starves behind another one's rows.
    """
    now = moment(as_of)
    fresh = _flag("to_be_processed", 0) & _flag("in_process", 0) & _at_rest(v.NEW)
    probation_over = (
        _flag("in_process", 1)
        & _at_rest(v.OPEN)
        & (F.col("comm_level2_date") < now - days("probation_gap_days"))
    )
    archived = _flag("in_process", 1) & _at_rest(v.SOURCE_ARCHIVED)
    due = jobs.filter(_active() & (fresh | probation_over | archived))
    if shard is not None:
        due = assign_shard(due, shard[1], keep=shard[0]).drop("shard")
    if limit is not None:
        due = due.orderBy("task_id").limit(limit)
    return due


def select_notify(jobs: DataFrame) -> DataFrame:
    """Jobs whose next notification has not been stamped yet."""
    first = _flag("to_be_processed", 1) & F.col("comm_level1_date").isNull()
    second = (
        _flag("in_process", 1)
        & F.col("comm_level1_date").isNotNull()
        & _at_rest(v.OPEN)
        & F.col("comm_level2_date").isNull()
    )
    third = (
        _flag("in_process", 0)
        & F.col("comm_level2_date").isNotNull()
        & _at_rest(v.SOURCE_ARCHIVED)
        & F.col("comm_level3_date").isNull()
    )
    return jobs.filter(_active() & (first | second | third))


def select_migrate(jobs: DataFrame, as_of) -> DataFrame:
    """Jobs whose notice period is over, and started jobs not yet at rest."""
    now = moment(as_of)
    notice_over = (
        _flag("to_be_processed", 1)
        & (F.col("comm_level1_date") < now - days("initial_gap_days"))
        & (F.col("state") == v.READY)
        & (F.col("desired_state") == v.LOCKED)
    )
    under_way = _flag("in_process", 1) & (F.col("state") != F.col("desired_state"))
    return jobs.filter(_active() & (notice_over | under_way))


def select_mirror(jobs: DataFrame) -> DataFrame:
    """Migrated jobs in probation that nobody is mirroring right now."""
    return jobs.filter(
        _active()
        & _at_rest(v.OPEN)
        & (F.col("probation_gap_days") > 0)
        & F.col("shadow_status").isNull()
    )


def select_revert(
    kinds: DataFrame, requested: DataFrame, require_probation: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(jobs to revert, rejected requests with a reason).

    ``kinds`` is the queue with the ``exists`` and ``is_source`` columns of
    ``classify_kind``. A request is rejected when its name is unknown or stands
    for several jobs; a job whose table is gone or already back in the source
    format is left alone. ``require_probation`` also leaves out jobs that are not
    at rest in probation.
    """
    wanted = requested.select(*KEY).distinct()
    matched = kinds.join(wanted, KEY, "left_semi")
    counts = matched.groupBy(*KEY).agg(F.count(F.lit(1)).alias("matches"))
    counted = wanted.join(counts, KEY, "left").select(
        *KEY, F.coalesce("matches", F.lit(0).cast("bigint")).alias("matches")
    )
    rejects = counted.filter("matches <> 1").select(
        *KEY,
        "matches",
        F.when(F.col("matches") == 0, "unknown table").otherwise("ambiguous table").alias("reason"),
    )
    moved = matched.filter(F.col("exists") & ~F.col("is_source"))
    if require_probation:
        moved = moved.filter(
            _at_rest(v.OPEN) & _flag("in_process", 1) & (F.col("probation_gap_days") > 0)
        )
    single = counts.filter("matches = 1").select(*KEY)
    extra = ("exists", "is_source")
    picked = moved.join(single, KEY, "left_semi").drop(*extra)
    return picked, rejects


def filter_batch(jobs: DataFrame, batches: DataFrame, batch_id: str) -> DataFrame:
    """Jobs whose catalog/db/table is listed for the batch; case does not matter.

    The batch id asked for is lower-cased, the one in the table is not.
    """
    listed = (
        batches.filter(F.col("batchId") == batch_id.lower())
        .select(F.lower("table_name").alias("__name"))
        .distinct()
    )
    return jobs.join(listed, F.lower(qualified("/")) == F.col("__name"), "left_semi")


def assign_shard(jobs: DataFrame, shards: int, keep: int | None = None) -> DataFrame:
    """Adds each job's shard (1..shards); with ``keep`` only that shard's rows."""
    out = jobs.withColumn("shard", shard_of(F.col("task_id"), shards))
    return out if keep is None else out.filter(F.col("shard") == keep)

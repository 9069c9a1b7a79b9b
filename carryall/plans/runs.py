"""One run of each component as a single plan over all due jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from carryall import vocabulary as v
from carryall.functions import sets
from carryall.functions.names import qualified
from carryall.operators import enrich, lifecycle, outbox, selectors
from carryall.sources.tables import pin


def preprocess_plan(
    jobs: DataFrame,
    catalog: DataFrame,
    metadata: DataFrame,
    contacts: DataFrame,
    meta_daily: DataFrame,
    meta_events: DataFrame,
    lineage: DataFrame,
    as_of,
    day_key: int,
    names: v.Naming = v.DEFAULT,
    limit: int | None = None,
    shard: tuple[int, int] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(changed jobs, their readers as task_id, downstream_user).

    The pairs are of all readers of the jobs that were looked up, however many; store
    them for the notification runs. The queue's column is an export of them.
    The large inputs are cut down to the tables that lack the fact in question
    before anything is aggregated.
    """
    due = pin(selectors.select_preprocess(jobs, as_of, limit, shard), "due")
    fresh = due.filter(F.col("state") == v.NEW)

    def lacking(column):
        return fresh.filter(sets.is_blank(F.col(column))).select(qualified("/").alias("table_name"))

    unowned = lacking("tbl_owners")
    owners = enrich.owner_candidates(
        contacts,
        meta_daily,
        meta_events.join(unowned, "table_name", "left_semi"),
        day_key,
        names,
    )
    unread = lacking("downstream_users").withColumnRenamed("table_name", "source_name")
    pairs = enrich.readers(lineage.join(unread, "source_name", "left_semi"), names)
    # Distinct pairs are a small part of the lineage, and are gone through three times.
    pairs = pin(pairs.withColumnRenamed("source_name", "table_name"), "readers")
    folded = enrich.fold_sets(pairs, ["table_name"], "downstream_user", "downstream_users")
    named = fresh.select("task_id", qualified("/").alias("table_name"))
    of_jobs = named.join(pairs, "table_name").select("task_id", "downstream_user")
    return lifecycle.preprocess_step(due, catalog, metadata, owners, folded, names), of_jobs


def migrate_plan(
    jobs: DataFrame,
    catalog: DataFrame,
    empty: DataFrame,
    as_of,
    names: v.Naming = v.DEFAULT,
    batches: DataFrame | None = None,
    batch_id: str | None = None,
    shard: tuple[int, int] | None = None,
    allow_text: bool = False,
) -> DataFrame:
    """Due jobs with their gate, ordered actions, end state and copy strategy.

    Jobs held at the gate take no action. What is left to do outside the plan is
    one Spark job per copy action and one catalogue edit per kind of rename.
    """
    due = selectors.select_migrate(jobs, as_of)
    if batch_id:
        due = selectors.filter_batch(due, batches, batch_id)
    if shard is not None:
        due = selectors.assign_shard(due, shard[1], keep=shard[0]).drop("shard")
    marked = enrich.mark_empty(due, empty)
    gated = lifecycle.migrate_gate(marked, catalog, names=names, allow_text=allow_text)
    moved = lifecycle.advance_jobs(gated, only=F.col("gate") == "go")
    planned = lifecycle.copy_strategy(
        moved.withColumn("__format", F.col("stg_format")), catalog, names=names
    )
    copies = F.array_contains("actions", "copy")
    return planned.withColumns(
        {
            "strategy": F.when(copies, F.col("strategy")),
            "stg_format": F.when(copies, F.col("stg_format")).otherwise(F.col("__format")),
        }
    ).drop("__format", "is_empty")


def notify_plan(
    jobs: DataFrame,
    catalog: DataFrame,
    empty: DataFrame,
    as_of,
    names: v.Naming = v.DEFAULT,
    readers: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(changed jobs, outbox rows) of one notification run.

    ``readers``(task_id, downstream_user) are the stored pairs; without them they
    are taken from the queue's column.
    """
    due = selectors.select_notify(jobs)
    # The mails and the stamps must come from the same rows, and both are read
    # several times.
    gated = pin(outbox.notify_gate(due, catalog, empty, as_of, names), "notify")
    mails = outbox.render_outbox(gated, as_of, names, readers)
    return gated.drop("due_level", "send_mail"), mails


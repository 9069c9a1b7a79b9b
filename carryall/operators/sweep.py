"""All mirrors that are due, each apart from the others."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from carryall import vocabulary as v
from carryall.functions.names import qualified
from carryall.functions.times import moment
from carryall.operators.movement import bring_up, in_sync, mark_commits, touched_partitions, watermarks
from carryall.operators.selectors import select_mirror
from carryall.sources.pool import WIDTH, each
from carryall.sources.tables import dotted, fresh_path, pin

MIRRORED, FAILED = "mirrored", "failed"
_TOUCHED = "partition_values map<string,string>"
_OUTCOME = (
    "task_id bigint, table_name string, snapshot_id bigint, outcome string, error string, "
    "rewritten int, dropped int"
)


def sweep_facts(
    jobs: DataFrame, ledger: DataFrame, mirror_log: DataFrame, folder: str
) -> DataFrame:
    """What a sweep has to know of every due table, from one plan over the ledger.

    Gives task_id, the key, table_name, snapshot_id (pinned), watermark, known (is the
    watermark in the ledger?) and n_touched. The partitions touched since are written to
    ``folder``, a subfolder for each task; a table with an unknown watermark has none
    there, as it is compared whole.
    """
    selected = select_mirror(jobs).withColumn("table_name", qualified("/"))
    due = in_sync(selected, ledger, watermarks(mirror_log)).filter(~F.col("in_sync")).filter("snapshot_id is not null")
    due = pin(due.select("task_id", "catalog_name", "db_name", "tbl_name", "table_name", "snapshot_id", "watermark"), "due")
    marks = due.select("table_name", "watermark").filter("watermark is not null").distinct()
    own = ledger.join(marks, "table_name", "left_semi")
    known = mark_commits(own, marks).select("table_name", F.lit(True).alias("known"))
    touched = touched_partitions(own, marks).join(known, "table_name", "left_semi")
    tasks = due.select("task_id", "table_name")
    touched.join(tasks, "table_name").select("task_id", "partition_values").write.partitionBy("task_id").parquet(folder)
    stored = due.sparkSession.read.schema(f"{_TOUCHED}, task_id bigint").parquet(folder)
    counts = stored.groupBy("task_id").agg(F.count(F.lit(1)).alias("n_touched"))
    facts = due.join(known, "table_name", "left").join(counts, "task_id", "left")
    zero = F.lit(0).cast("long")
    return facts.withColumns(
        {"known": F.coalesce("known", F.lit(False)), "n_touched": F.coalesce("n_touched", zero)}
    )


def mirror_sweep(
    spark: SparkSession,
    jobs: DataFrame,
    ledger: DataFrame,
    mirror_log: DataFrame,
    mirrored_at,
    names: v.Naming = v.DEFAULT,
    verify: bool = False,
    on_status: Callable[[int, str | None], None] | None = None,
    sql_name: Callable[[str, str, str], str] | None = None,
    width: int = WIDTH,
) -> tuple[DataFrame, DataFrame]:
    """Mirrors every selected job that is out of sync: (mirror-log rows, outcomes).

    A table's target serves as the source of the mirror and its kept source (the
    suffixed table) as the destination. The ledger is read for all tables together; then
    ``width`` writers work at a time, each with a session of its own. A table that fails
    has an outcome with its error and no log row, so that the next sweep takes it up
    again; the others are mirrored and logged.

    The outcomes are task_id, table_name, snapshot_id, outcome (mirrored or failed),
    error, rewritten, dropped, a row for every table that was due. ``on_status(task_id,
    status)`` is told before and after each table, failed or not, for a queue that should
    show it; it is called from the writers' threads. ``sql_name(catalog, db, table)``
    spells a table for Spark (catalog.db.table by default). Names and counts come to the
    driver, as many at a time as there are writers.
    """
    spell = sql_name or dotted
    folder = fresh_path(spark, "touched")
    facts = pin(sweep_facts(jobs, ledger, mirror_log, folder), "facts")

    def work(session: SparkSession, job) -> tuple[int, int]:
        if on_status:
            on_status(job["task_id"], v.MIRRORING)
        try:
            touched = None
            if job["known"] and not verify:
                path = f"{folder}/task_id={job['task_id']}"
                rows = session.read.schema(_TOUCHED)
                touched = rows.parquet(path) if job["n_touched"] else session.createDataFrame([], _TOUCHED)
            key = job["catalog_name"], job["db_name"]
            src = spell(*key, job["tbl_name"])
            return bring_up(session, src, spell(*key, job["tbl_name"] + names.source_suffix), touched)
        finally:
            if on_status:
                on_status(job["task_id"], None)

    outcomes = []
    for job, value, error in each(spark, facts.toLocalIterator(), work, width, "mirror"):
        rewritten, dropped = value or (None, None)
        state = FAILED if error else MIRRORED
        outcomes.append((job["task_id"], job["table_name"], job["snapshot_id"], state, error, rewritten, dropped))
    done = spark.createDataFrame(outcomes, _OUTCOME)
    log = done.filter(F.col("outcome") == MIRRORED).select(
        "table_name", "snapshot_id", moment(mirrored_at).alias("mirrored_at"), "rewritten", "dropped"
    )
    return log, done

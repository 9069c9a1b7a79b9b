"""Queries that carry runs out on real tables made of the given ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from carryall import vocabulary as v
from carryall.operators import movement
from carryall.plans import conduct
from carryall.plans.fixtures import AS_OF, base
from carryall.plans.movement_queries import make_table
from carryall.plans.registry import query
from carryall.schemas import CATALOG, JOB, KEY
from carryall.sources.appends import append_rows
from carryall.sources.partitions import file_manifest, foreign_files
from carryall.sources.store import Journal, StoredTable
from carryall.sources.tables import fresh_name, pin

_CATALOG, _DB = "spark_catalog", "default"
# Tables that are migrated: partition columns, key, and the rows that come late.
_FLEET = {
    "orders": (["o_orderstatus"], "o_orderkey", "o_orderkey % 7 = 3"),
    "customer": (["c_mktsegment"], "c_custkey", "c_mktsegment = 'BUILDING'"),
    "part": ([], "p_partkey", "p_size > 40"),
}
# A table that is in the catalogue, but has no files or definition.
_LOST = "lost"


def _control(spark: SparkSession, sf: str, late: bool) -> tuple[conduct.Control, dict[str, str]]:
    """The fleet with its control tables; without the late rows, if ``late``."""
    labels, jobs, entries = {}, [], []
    for n, label in enumerate([*_FLEET, _LOST], start=1):
        name = fresh_name(label)
        if label != _LOST:
            parts, _, later = _FLEET[label]
            rows = base(spark, sf, label)
            make_table(rows.filter(f"not coalesce({later}, false)") if late else rows, label, parts, name=name)
        labels[name] = label
        key = {"catalog_name": _CATALOG, "db_name": _DB, "tbl_name": name}
        job = {f.name: None for f in JOB.fields} | key | {
            "task_id": n, "stg_format": v.PARQUET, "to_be_processed": 1, "in_process": 0, "state": v.READY,
            "desired_state": v.LOCKED, "initial_gap_days": 1, "probation_gap_days": 7, "migration_paused": 0,
            "pause_reason": v.NOT_PAUSED,
        }
        jobs.append(tuple(job.values()))
        row = {f.name: None for f in CATALOG.fields} | key | {
            "table_type": "EXTERNAL_TABLE", "data_uri": f"file:/{label}", "data_size": 1, "tags": ["team_a"],
            "fields": [("c1", "timestamp" if label == "customer" else "bigint")],
        }
        entries.append(tuple(row.values()))
    told = F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")
    queue = spark.createDataFrame(jobs, JOB).withColumn("comm_level1_date", told)
    catalog = spark.createDataFrame(entries, CATALOG)
    return conduct.Control(spark, StoredTable(spark, queue, "queue"), StoredTable(spark, catalog, "catalog"), Journal(spark)), labels


def _migrated(spark: SparkSession, sf: str, late: bool = False) -> tuple[conduct.Control, dict[str, str]]:
    control, labels = _control(spark, sf, late)
    conduct.migrate_run(control, control.queue.read().select(*KEY).limit(0), AS_OF, "run_1")
    return control, labels


def _late(spark: SparkSession, sf: str, labels: dict[str, str]) -> DataFrame:
    """Writes the late rows to the migrated tables; the ledger of these commits."""
    ledger = None
    for name, label in labels.items():
        if label == _LOST:
            continue
        table = spark.table(name)
        rows = base(spark, sf, label).filter(_FLEET[label][2]).select(*table.columns)
        commit = append_rows(rows, name, 7, AS_OF).withColumn("table_name", F.lit(f"{_CATALOG}/{_DB}/{name}"))
        ledger = commit if ledger is None else ledger.unionByName(commit)
    return pin(ledger, "ledger")


def _labelled(spark: SparkSession, labels: dict[str, str]) -> DataFrame:
    return F.broadcast(spark.createDataFrame(list(labels.items()), "tbl_name string, label string"))


def _keys(spark: SparkSession, labels: dict[str, str], suffix: str = "") -> DataFrame:
    """(label, key) of all rows of the tables as they are."""
    out = None
    for name, label in labels.items():
        if label != _LOST:
            one = spark.table(name + suffix).select(F.lit(label).alias("label"), F.col(_FLEET[label][1]).alias("row_key"))
            out = one if out is None else out.unionAll(one)
    return out


_KEYS_SQL = " union all ".join(f"select '{label}' label, {key} row_key from {label}" for label, (_, key, _) in _FLEET.items())
_LABELS_SQL = "(values " + ", ".join(f"('{label}')" for label in _FLEET) + ") l(label)"


@query(
    "migrate_run",
    f"""select label, stage, 'done' outcome, 'OPEN' state, 'OPEN' desired_state
 from {_LABELS_SQL} cross join (values ('lock'), ('copy'), ('promote'), ('unlock')) s(stage)
union all values ('lost', 'lock', 'done', 'LOCKED', 'COPIED'), ('lost', 'copy', 'failed', 'LOCKED', 'COPIED')""",
)
def _(spark, sf):
    """The stages of a run in which one table cannot be read, and where the jobs stand."""
    control, labels = _migrated(spark, sf)
    jobs = control.queue.read().select("task_id", "tbl_name", "state", "desired_state")
    stages = control.journal.stages("run_1").join(jobs, "task_id")
    return stages.join(_labelled(spark, labels), "tbl_name").select("label", "stage", "outcome", "state", "desired_state")


@query("migrate_run_content", f"select label, row_key, side from ({_KEYS_SQL}) k cross join (values ('target'), ('source')) s(side)")
def _(spark, sf):
    """All rows of the migrated tables and of the sources that were kept."""
    _, labels = _migrated(spark, sf)
    target = _keys(spark, labels).withColumn("side", F.lit("target"))
    return target.unionAll(_keys(spark, labels, "_source").withColumn("side", F.lit("source")))


@query(
    "migrate_run_resumed",
    f"""select label, count(*) n_rows, 'ICEBERG' table_type, 'OPEN' state from ({_KEYS_SQL}) k group by label""",
)
def _(spark, sf):
    """A run whose catalogue write is lost after the renames; the same run goes on."""
    control, labels = _control(spark, sf, late=False)
    empty = control.queue.read().select(*KEY).limit(0)
    replace, calls = control.catalog.replace, []

    def lost_once(rows):
        calls.append(1)
        if len(calls) == 3:
            raise InterruptedError("cut off")
        replace(rows)

    control.catalog.replace = lost_once
    try:
        conduct.migrate_run(control, empty, AS_OF, "run_1")
    except InterruptedError:
        control.catalog.replace = replace
    conduct.migrate_run(control, empty, AS_OF, "run_1")
    known = _labelled(spark, labels)
    counts = _keys(spark, labels).groupBy("label").agg(F.count(F.lit(1)).alias("n_rows"))
    kinds = control.catalog.read().join(known, "tbl_name").select("label", "table_type")
    states = control.queue.read().join(known, "tbl_name").select("label", "state")
    return counts.join(kinds, "label").join(states, "label")


_LATE_SQL = " union all ".join(
    f"select '{label}' label, count(*) n_late, count(*) filter (where {later}) > 0 moved from {label} where {later}"
    for label, (_, _, later) in _FLEET.items()
)


@query(
    "mirror_run",
    f"""select label, case when label = 'part' then 'failed' else 'mirrored' end outcome, label <> 'part' logged,
 case when label = 'part' then n_late else 0 end n_missing, cast(null as varchar) shadow_status from ({_LATE_SQL}) t where moved""",
)
def _(spark, sf):
    """A sweep in which one kept source is gone: what became of each, and the rows still missing there."""
    control, labels = _migrated(spark, sf, late=True)
    ledger = _late(spark, sf, labels)
    gone = next(name for name, label in labels.items() if label == "part")
    spark.sql(f"ALTER TABLE {gone}_source RENAME TO {gone}_aside")
    none = spark.createDataFrame([], "table_name string, snapshot_id bigint, mirrored_at timestamp_ntz")
    log, outcomes = conduct.mirror_run(control, ledger, none, AS_OF, "run_2")
    spark.sql(f"ALTER TABLE {gone}_aside RENAME TO {gone}_source")
    known = _labelled(spark, labels)
    left = _keys(spark, labels).exceptAll(_keys(spark, labels, "_source"))
    missing = left.groupBy("label").agg(F.count(F.lit(1)).alias("n_missing"))
    status = control.queue.read().join(known, "tbl_name").select("label", "task_id", "shadow_status")
    logged = log.select("table_name", F.lit(True).alias("logged"))
    rows = status.join(outcomes, "task_id").join(logged, "table_name", "left").join(missing, "label", "left")
    return rows.select(
        "label", "outcome", F.coalesce("logged", F.lit(False)).alias("logged"),
        F.coalesce("n_missing", F.lit(0).cast("bigint")).alias("n_missing"), "shadow_status",
    )


@query("revert_run", _KEYS_SQL)
def _(spark, sf):
    """Tables migrated, written to, and reverted: the old ones have all rows, the late too."""
    control, labels = _migrated(spark, sf, late=True)
    _late(spark, sf, labels)
    asked = control.queue.read().filter(F.col("state") == v.OPEN).select(*KEY)
    conduct.revert_run(control, asked, AS_OF, "run_3")
    return _keys(spark, labels)


@query(
    "revert_finalized_run",
    f"""select label, 'READY' state, 'LOCKED' desired_state, 1 migration_paused, true swapped, 'EXTERNAL_TABLE' table_type
 from {_LABELS_SQL}""",
)
def _(spark, sf):
    """Finished migrations, their sources archived, swapped back."""
    control, labels = _migrated(spark, sf)
    done = control.queue.read().filter(F.col("state") == v.OPEN).withColumn("desired_state", F.lit(v.SOURCE_ARCHIVED))
    control.put(pin(done, "done"), AS_OF)
    conduct.migrate_run(control, done.select(*KEY).limit(0), AS_OF, "run_2")
    asked = control.queue.read().filter(F.col("state") == v.SOURCE_ARCHIVED).select(*KEY)
    _, told = conduct.revert_finalized_run(control, pin(asked, "asked"), AS_OF, "run_4")
    known = _labelled(spark, labels)
    jobs = control.queue.read().join(told.select("tbl_name", "swapped"), "tbl_name")
    kinds = control.catalog.read().select("tbl_name", "table_type")
    return jobs.join(kinds, "tbl_name").join(known, "tbl_name").select(
        "label", "state", "desired_state", "migration_paused", "swapped", "table_type"
    )


_PARTS = ["l_returnflag", "l_linestatus"]


@query(
    "append_to_snapshot",
    f"""with late as (select {', '.join(_PARTS)}, l_linenumber > 5 late from lineitem)
select {', '.join(_PARTS)}, cast(count(*) as bigint) n_rows, bool_or(l_returnflag = 'R' and late) own from late group by all""",
)
def _(spark, sf):
    """Rows appended to a snapshot: only the partitions they go to have files of their own."""
    lineitem = base(spark, sf, "lineitem")
    late = (F.col("l_returnflag") == "R") & (F.col("l_linenumber") > 5)
    src, dst = make_table(lineitem.filter(~late), "lineitem", _PARTS), fresh_name("snapshot")
    movement.snapshot_table(spark, src, dst)
    table = spark.table(dst)
    append_rows(lineitem.filter(late).select(*table.columns), dst, 2, AS_OF)
    rows = spark.table(dst)
    shared = foreign_files(spark, dst, rows, _PARTS).select(*_PARTS, F.lit(False).alias("own")).distinct()
    counts = file_manifest(rows, _PARTS).groupBy(*_PARTS).agg(F.sum("record_count").alias("n_rows"))
    return counts.join(shared, _PARTS, "left").withColumn("own", F.coalesce("own", F.lit(True)))


@query(
    "append_rows_true_ledger",
    "select event_type partition_value, count(*) record_count from events where user_id % 2 = 1 group by event_type",
)
def _(spark, sf):
    """The ledger of an input that has more rows when it is read again."""
    events = base(spark, sf, "events")
    moved = [c for c in events.columns if c != "event_type"] + ["event_type"]
    table = make_table(events.filter("user_id % 2 = 0").select(*moved), "events", ["event_type"])
    source = make_table(events.filter("user_id % 2 = 1").select(*moved), "events", [])
    rows = spark.table(source)
    ledger = append_rows(rows, table, 2, AS_OF)
    events.limit(100).select(*moved).write.insertInto(source)
    part = F.col("partition_values")["event_type"].alias("partition_value")
    return ledger.select(part, "record_count")

"""Queries over what is kept up to date step by step, and over parts of partitions."""

from __future__ import annotations

from pyspark.sql import functions as F

from carryall.operators import enrich, movement
from carryall.plans import movement_queries as shared
from carryall.plans.enrich_queries import READERS
from carryall.plans.fixtures import AS_OF, base, fixture, jobs, parts_of
from carryall.plans.registry import IS_SOURCE, flat, query, sql_time
from carryall.schemas import KEY
from carryall.sources import queue
from carryall.sources.ledger import LedgerSummary
from carryall.sources.readers import ReaderPairs
from carryall.sources.tables import fresh_path, probe_folders

_KEY_SQL = ", ".join(KEY)


# ---------------------------------------------------------------- ledger


def _summary(spark, sf) -> LedgerSummary:
    """A summary of the ledger that took it in by two steps, the later commits first."""
    path = fresh_path(spark, "ledger")
    rows = shared._ledger(spark, sf).select("table_name", "snapshot_id", "committed_at", "partition_values", "record_count")
    summary = None
    for half in ("snapshot_id % 2 = 1", "snapshot_id % 2 = 0"):
        rows.filter(half).write.mode("append").parquet(path)
        summary = summary or LedgerSummary(spark, path)
        summary.fold()
    return summary


@query(
    "ledger_summary",
    f"""select table_name, part, {sql_time('max(committed_at)')} committed_at, max_by(snapshot_id, committed_at) snapshot_id
 from ledger group by table_name, part""",
)
def _(spark, sf):
    part = F.col("partition_values")["part"].alias("part")
    return flat(_summary(spark, sf).partitions().select("table_name", part, "committed_at", "snapshot_id"))


@query("touched_partitions_by_summary", shared._TOUCHED)
def _(spark, sf):
    summary = _summary(spark, sf)
    found = movement.touched_partitions(summary.partitions(), shared._marks(spark, sf), summary.commits())
    return found.select("table_name", F.col("partition_values")["part"].alias("part"))


# ---------------------------------------------------------------- readers


@query("reader_pairs_by_day", READERS)
def _(spark, sf):
    """The lineage comes in two halves; the days of the first are closed, and not read again."""
    lineage = fixture(spark, sf, "lineage")
    ends = lineage.agg(F.min("day"), F.max("day")).first()
    middle = ends[0] + (ends[1] - ends[0]) / 2
    pairs = ReaderPairs(spark)
    pairs.update(lineage.filter(F.col("day") < F.lit(middle)), middle)
    pairs.update(lineage, ends[1])
    return pairs.read()


# ---------------------------------------------------------------- queue


def _versioned(spark, sf):
    return jobs(spark, sf).withColumn("version", F.col("task_id") % 3)


_SETTLED = """judged as (select c.*, j.task_id is null is_unknown, c.version <> j.task_id % 3 is_stale
 from changes c left join jobs j on c.task_id = j.task_id and c.tbl_name = j.tbl_name),
good as (select *, row_number() over (partition by task_id, tbl_name order by changed_at desc) n
 from judged where not is_unknown and not is_stale)"""


@query(
    "settle_changes",
    f"""with {_SETTLED} select j.task_id, coalesce(g.state, j.state) state, coalesce(g.run_id, j.run_id) run_id,
 case when g.task_id is null then {sql_time('j.last_updated_time')} else '{AS_OF}' end last_updated_time,
 j.task_id % 3 + case when g.task_id is null then 0 else 1 end "version"
 from jobs j left join (select * from good where n = 1) g on j.task_id = g.task_id""",
)
def _(spark, sf):
    all_jobs = _versioned(spark, sf)
    made, _ = queue.settle_changes(all_jobs, fixture(spark, sf, "changes"), parts=parts_of(spark, sf, "changes"))
    done = queue.upsert_jobs(all_jobs, made, AS_OF)
    return flat(done.select("task_id", "state", "run_id", "last_updated_time", "version"))


@query(
    "settle_changes_rejects",
    f"""with {_SETTLED} select task_id, tbl_name, run_id, {sql_time('changed_at')} changed_at,
 case when is_unknown then 'unknown' else 'stale' end reason from judged where is_unknown or is_stale
union all select task_id, tbl_name, run_id, {sql_time('changed_at')}, 'superseded' from good where n > 1""",
)
def _(spark, sf):
    _, rejects = queue.settle_changes(_versioned(spark, sf), fixture(spark, sf, "changes"), parts=parts_of(spark, sf, "changes"))
    return flat(rejects.select("task_id", "tbl_name", "run_id", "changed_at", "reason"))


# ---------------------------------------------------------------- probe


# The folder of a table is that of its number among this many, and every third is filled.
_FOLDERS = 200


@query(
    "probe_folders",
    f"""select {_KEY_SQL} from catalog where ({IS_SOURCE}) and (data_size is null or data_size = -1)
 and cast(substr(tbl_name, 7) as bigint) % {_FOLDERS} in
  (select l_orderkey % {_FOLDERS} from lineitem where l_orderkey % {_FOLDERS} % 3 = 0)""",
)
def _(spark, sf):
    """Tables of unknown size in folders that hold rows, hold a file without rows, or are not there."""
    path = fresh_path(spark, "folders")
    lines = base(spark, sf, "lineitem").withColumn("number", F.col("l_orderkey") % _FOLDERS).select("number", "l_linenumber")
    lines.filter("number % 3 = 0").write.partitionBy("number").parquet(path)
    lines.drop("number").limit(0).write.parquet(f"{path}/number=1")
    keys = enrich.unknown_size_tables(jobs(spark, sf), fixture(spark, sf, "catalog"))
    number = F.substring("tbl_name", 7, 20).cast("bigint") % _FOLDERS
    location = F.concat(F.lit(f"{path}/number="), number.cast("string"))
    return probe_folders(spark, keys.select(*KEY, location.alias("location")))


# ---------------------------------------------------------------- ranges

_WIDTH = 1000
_RANGES = f"""with {shared._STALE}, rows_ as (select {shared._COLUMNS}, sum(s) s, sum(d) d
 from (select {shared._COLUMNS}, 1 s, 0 d from lineitem union all select {shared._COLUMNS}, 0, 1 from stale) b group by {shared._COLUMNS})
select {shared._PARTS_SQL}, cast(l_orderkey - l_orderkey % {_WIDTH} as bigint) key_from,
 cast(l_orderkey - l_orderkey % {_WIDTH} + {_WIDTH - 1} as bigint) key_to,
 cast(sum(s) as bigint) n_src, cast(sum(d) as bigint) n_dst
from rows_ group by 1, 2, 3, 4 having count(*) filter (where s <> d) > 0"""


@query("changed_ranges", _RANGES)
def _(spark, sf):
    return movement.changed_ranges(*shared._pair(spark, sf), shared._PARTS, "l_orderkey", _WIDTH)


@query(
    "range_difference",
    f"""with {shared._STALE} select {shared._LINE}, cast(sum(s) as bigint) n_src, cast(sum(d) as bigint) n_dst
 from (select {shared._COLUMNS}, 1 s, 0 d from lineitem union all select {shared._COLUMNS}, 0, 1 from stale) b
 group by {shared._COLUMNS} having sum(s) <> sum(d)""",
)
def _(spark, sf):
    """The same rows as the full comparison finds, from the changed ranges alone."""
    src, dst = shared._pair(spark, sf)
    ranges = movement.changed_ranges(src, dst, shared._PARTS, "l_orderkey", _WIDTH)
    return flat(movement.range_difference(src, dst, shared._PARTS, "l_orderkey", ranges))


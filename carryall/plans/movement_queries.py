"""Queries that copy, compare and mirror user tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from carryall.operators import movement, sweep
from carryall.plans.fixtures import AS_OF, base, fixture
from carryall.plans.registry import flat, query, sql_time
from carryall.schemas import JOB
from carryall.sources.appends import append_rows
from carryall.sources.tables import commit_rows, fresh_name, fresh_path, pin, spread

_PARTS = ["l_returnflag", "l_linestatus"]
_PARTS_SQL = ", ".join(_PARTS)
_LINE = f"""l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
 l_returnflag, l_linestatus, {sql_time('l_shipdate')} l_shipdate"""
_EVENT = f"event_id, {sql_time('ts')} ts, user_id, event_type, value, props"


def make_table(df: DataFrame, label: str, parts: list[str], name: str | None = None) -> str:
    """Writes an external Parquet table to the shared folder."""
    name = name or fresh_name(label)
    writer = spread(df, parts).write.format("parquet").option("path", fresh_path(df.sparkSession, label))
    if parts:
        writer = writer.partitionBy(*parts)
    writer.saveAsTable(name)
    return name


# ---------------------------------------------------------------- writes


def _appended(spark, sf):
    """Events written in two commits to a table partitioned by event type."""
    events = base(spark, sf, "events")
    moved = [c for c in events.columns if c != "event_type"] + ["event_type"]
    first = events.filter("user_id % 2 = 0").select(*moved)
    table = make_table(first, "events", ["event_type"])
    # By position: the names of the appended columns do not matter.
    rest = events.filter("user_id % 2 = 1").select(*moved).toDF(*[f"c{i}" for i in range(6)])
    return table, append_rows(rest, table, 2, AS_OF)


@query("append_rows", f"select {_EVENT} from events")
def _(spark, sf):
    table, _ = _appended(spark, sf)
    return flat(spark.table(table))


@query(
    "append_rows_ledger",
    f"""select 2 snapshot_id, '{AS_OF}' committed_at, 'append' operation, event_type partition_value,
 count(*) record_count from events where user_id % 2 = 1 group by event_type""",
)
def _(spark, sf):
    _, ledger = _appended(spark, sf)
    part = F.col("partition_values")["event_type"].alias("partition_value")
    return flat(ledger.select("snapshot_id", "committed_at", "operation", part, "record_count"))


@query("snapshot_manifest", f"select {_PARTS_SQL}, count(*) record_count from lineitem group by all")
def _(spark, sf):
    src = make_table(base(spark, sf, "lineitem"), "lineitem", _PARTS)
    files = movement.snapshot_manifest(spark.table(src), _PARTS)
    # Files per partition depend on the cluster; their rows do not.
    return files.groupBy(*_PARTS).agg(F.sum("record_count").alias("record_count"))


@query("snapshot_table", f"select {_LINE} from lineitem")
def _(spark, sf):
    src = make_table(base(spark, sf, "lineitem"), "lineitem", _PARTS)
    dst = fresh_name("snapshot")
    movement.snapshot_table(spark, src, dst)
    return flat(spark.table(dst))


@query("rewrite_copy", f"select {_LINE} from lineitem")
def _(spark, sf):
    src = make_table(base(spark, sf, "lineitem"), "lineitem", _PARTS)
    dst = fresh_name("copy")
    return flat(movement.rewrite_copy(spark, src, dst, location=fresh_path(spark, "copy")))


@query("rewrite_copy_of_text", f"select {_EVENT} from events")
def _(spark, sf):
    """A CSV table cannot be snapshotted: the copy falls back to a rewrite."""
    src, dst = fresh_name("text"), fresh_name("copy")
    path = fresh_path(spark, "text")
    base(spark, sf, "events").write.format("csv").option("path", path).saveAsTable(src)
    movement.copy_table(spark, src, dst, "SNAPSHOT", location=fresh_path(spark, "copy"))
    return flat(spark.table(dst))


# ---------------------------------------------------------------- ledger


def _ledger(spark, sf):
    return fixture(spark, sf, "ledger").withColumn(
        "partition_values", F.create_map(F.lit("part"), F.col("part"))
    )


def _marks(spark, sf):
    return movement.watermarks(fixture(spark, sf, "mirror_log"))


_LATEST = "select table_name, max_by(snapshot_id, committed_at) snapshot_id from ledger group by table_name"
_MARKS = "select table_name, max_by(snapshot_id, mirrored_at) watermark from mirror_log group by table_name"


@query("latest_snapshot", _LATEST)
def _(spark, sf):
    return movement.latest_snapshot(fixture(spark, sf, "ledger"))


@query("watermarks", _MARKS)
def _(spark, sf):
    return _marks(spark, sf)


@query(
    "set_watermarks",
    f"select table_name, snapshot_id, '{AS_OF}' mirrored_at from ({_LATEST}) where table_name in (select table_name from mirror_log)",
)
def _(spark, sf):
    tables = fixture(spark, sf, "mirror_log").select("table_name")
    return flat(movement.set_watermarks(tables, fixture(spark, sf, "ledger"), AS_OF))


@query(
    "in_sync",
    f"""with latest as ({_LATEST}), marks as ({_MARKS}) select table_name, snapshot_id, watermark,
 snapshot_id = coalesce(watermark, -1) in_sync from latest left join marks using (table_name)""",
)
def _(spark, sf):
    tables = fixture(spark, sf, "ledger").select("table_name").distinct()
    return movement.in_sync(tables, fixture(spark, sf, "ledger"), _marks(spark, sf))


_TOUCHED = f"""with marks as ({_MARKS}), placed as (select l.table_name, max(committed_at) mark
  from ledger l join marks m on l.table_name = m.table_name and l.snapshot_id = m.watermark group by l.table_name)
select distinct l.table_name, part from ledger l left join placed p on l.table_name = p.table_name
where mark is null or committed_at > mark"""


@query("touched_partitions", _TOUCHED)
def _(spark, sf):
    found = movement.touched_partitions(_ledger(spark, sf), _marks(spark, sf))
    return found.select("table_name", F.col("partition_values")["part"].alias("part"))


# ---------------------------------------------------------------- parity


@query("partition_stats", f"select {_PARTS_SQL}, count(*) record_count from lineitem group by all")
def _(spark, sf):
    return movement.partition_stats(base(spark, sf, "lineitem"), _PARTS)


@query(
    "stats_total",
    f"""select count(*) partitions, cast(sum(n) as bigint) record_count
 from (select {_PARTS_SQL}, count(*) n from lineitem group by all) s""",
)
def _(spark, sf):
    return movement.stats_total(movement.partition_stats(base(spark, sf, "lineitem"), _PARTS))


def stale_copy(lineitem: DataFrame) -> DataFrame:
    """lineitem as an out-of-date destination has it.

    (A,F) lacks rows, (R,O) has other values, (N,F) is missing, (Z,Z) is gone
    from the source.
    """
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    lost = (flag == "A") & (status == "F") & (F.col("l_orderkey") % 7 == 0)
    absent = (flag == "N") & (status == "F")
    other = (flag == "R") & (status == "O") & (F.col("l_orderkey") % 11 == 0)
    kept = lineitem.filter(~lost & ~absent).withColumn(
        "l_tax", F.when(other, F.col("l_tax") + 1).otherwise(F.col("l_tax"))
    )
    extra = lineitem.filter((flag == "R") & (status == "F")).withColumns(
        {"l_returnflag": F.lit("Z"), "l_linestatus": F.lit("Z")}
    )
    return kept.unionByName(extra)


_COLUMNS = """l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
 l_returnflag, l_linestatus, l_shipdate"""
_STALE = """stale as (select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
  case when l_returnflag = 'R' and l_linestatus = 'O' and l_orderkey % 11 = 0 then l_tax + 1 else l_tax end l_tax,
  l_returnflag, l_linestatus, l_shipdate from lineitem
 where not (l_returnflag = 'A' and l_linestatus = 'F' and l_orderkey % 7 = 0)
  and not (l_returnflag = 'N' and l_linestatus = 'F')
 union all select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
  'Z', 'Z', l_shipdate from lineitem where l_returnflag = 'R' and l_linestatus = 'F')"""


def _pair(spark, sf):
    lineitem = base(spark, sf, "lineitem")
    return lineitem, stale_copy(lineitem)


@query(
    "row_parity",
    f"""with {_STALE} select (select count(*) from lineitem) n_src, (select count(*) from stale) n_dst,
 (select count(*) from lineitem) = (select count(*) from stale) as "equal" """,
)
def _(spark, sf):
    return movement.row_parity(*_pair(spark, sf))


@query(
    "table_parity",
    f"""with {_STALE}, s as (select {_PARTS_SQL}, count(*) n from lineitem group by all),
d as (select {_PARTS_SQL}, count(*) n from stale group by all)
select {_PARTS[0]} || '/' || {_PARTS[1]} table_name, coalesce(s.n, 0) n_src, coalesce(d.n, 0) n_dst,
 coalesce(s.n, 0) = coalesce(d.n, 0) as "equal" from s full join d using ({_PARTS_SQL})""",
)
def _(spark, sf):
    def stats(df):
        name = F.concat_ws("/", *_PARTS).alias("table_name")
        return movement.partition_stats(df, _PARTS).select(name, "record_count")

    src, dst = _pair(spark, sf)
    return movement.table_parity(stats(src), stats(dst))


@query(
    "content_difference",
    f"""with {_STALE} select {_LINE}, cast(sum(s) as bigint) n_src, cast(sum(d) as bigint) n_dst
 from (select {_COLUMNS}, 1 s, 0 d from lineitem union all select {_COLUMNS}, 0, 1 from stale) b
 group by {_COLUMNS} having sum(s) <> sum(d)""",
)
def _(spark, sf):
    return flat(movement.content_difference(*_pair(spark, sf)))


_CHANGED = f"""with {_STALE}, rows_ as (select {_COLUMNS}, sum(s) s, sum(d) d
 from (select {_COLUMNS}, 1 s, 0 d from lineitem union all select {_COLUMNS}, 0, 1 from stale) b group by {_COLUMNS})
select {_PARTS_SQL}, case when sum(d) = 0 then 'added' when sum(s) = 0 then 'removed' else 'changed' end kind,
 cast(sum(s) as bigint) n_src, cast(sum(d) as bigint) n_dst
from rows_ group by {_PARTS_SQL} having bool_or(s <> d)"""


@query("changed_partitions", _CHANGED)
def changed_partitions(spark: SparkSession, sf: str) -> DataFrame:
    return movement.changed_partitions(*_pair(spark, sf), _PARTS)


@query(
    "changed_partitions_with_map",
    """select event_type, 'changed' kind, count(*) n_src, count(*) n_dst from events
 group by event_type having bool_or(user_id % 100 = 7 and event_type in ('click', 'error'))""",
)
def _(spark, sf):
    events = base(spark, sf, "events").withColumn("props", F.create_map(F.lit("k"), "props"))
    hit = (F.col("user_id") % 100 == 7) & F.col("event_type").isin("click", "error")
    other = events.withColumn(
        "props", F.when(hit, F.create_map(F.lit("j"), F.col("props")["k"])).otherwise(F.col("props"))
    )
    return movement.changed_partitions(events, other, ["event_type"])


# ---------------------------------------------------------------- mirror


@query("mirror_updates", f"select {_LINE} from lineitem")
def _(spark, sf):
    lineitem, stale = _pair(spark, sf)
    src = make_table(lineitem, "lineitem", _PARTS)
    dst = make_table(stale, "mirror", _PARTS)
    movement.mirror_updates(spark, src, dst, AS_OF)
    return flat(spark.table(dst))


@query(
    "mirror_updates_log",
    f"""select 3 rewritten, 1 dropped, '{AS_OF}' mirrored_at""",
)
def _(spark, sf):
    lineitem, stale = _pair(spark, sf)
    src = make_table(lineitem, "lineitem", _PARTS)
    dst = make_table(stale, "mirror", _PARTS)
    log = movement.mirror_updates(spark, src, dst, AS_OF)
    return flat(log.select("rewritten", "dropped", "mirrored_at"))


@query("mirror_updates_by_ledger", f"select {_LINE} from lineitem")
def _(spark, sf):
    lineitem = base(spark, sf, "lineitem")
    moved = [c for c in lineitem.columns if c not in _PARTS] + _PARTS
    late = (F.col("l_returnflag") == "R") & (F.col("l_linenumber") > 3)
    early = lineitem.filter(~late).select(*moved)
    src = make_table(early, "lineitem", _PARTS)
    dst = make_table(early, "mirror", _PARTS)
    one = commit_rows(early, src, _PARTS, 1, "1998-06-01 00:00:00", "append")
    two = append_rows(lineitem.filter(late).select(*moved), src, 2, "1998-06-02 00:00:00")
    ledger = pin(one.unionByName(two), "ledger")
    movement.mirror_updates(spark, src, dst, AS_OF, ledger=ledger, watermark=1)
    return flat(spark.table(dst))


@query("mirror_of_unpartitioned", f"select {_EVENT} from events")
def _(spark, sf):
    events = base(spark, sf, "events")
    src = make_table(events, "events", [])
    dst = make_table(events.filter("event_type <> 'click'"), "mirror", [])
    movement.mirror_updates(spark, src, dst, AS_OF)
    return flat(spark.table(dst))


# Tables of the sweep: partition columns and what their stale copy lacks.
_SWEPT = {
    "orders": (["o_orderstatus"], "o_orderstatus <> 'F' or o_orderkey % 3 <> 0"),
    "events": (["event_type"], "event_type <> 'click'"),
    "customer": (["c_mktsegment"], "c_custkey % 5 <> 0"),
    "part": ([], "p_size > 10"),
}
_SYNCED = "customer"


@query(
    "mirror_sweep",
    """select 'orders' table_name, (select count(*) from orders) n_src, (select count(*) from orders) n_dst, true as "equal"
union all select 'events', (select count(*) from events), (select count(*) from events), true
union all select 'part', (select count(*) from part), (select count(*) from part), true
union all select 'customer', count(*), count(*) filter (where c_custkey % 5 <> 0), count(*) = count(*) filter (where c_custkey % 5 <> 0)
 from customer""",
)
def _(spark, sf):
    """A sweep over four tables; the one whose watermark is current is left alone."""
    jobs, ledger, log, labels = [], None, [], {}
    for n, (label, (parts, present)) in enumerate(_SWEPT.items(), start=1):
        rows = base(spark, sf, label)
        name = make_table(rows, label, parts)
        make_table(rows.filter(present), label, parts, name=f"{name}_source")
        job = {f.name: None for f in JOB.fields} | {
            "task_id": n,
            "catalog_name": "spark_catalog",
            "db_name": "default",
            "tbl_name": name,
            "state": "OPEN",
            "desired_state": "OPEN",
            "probation_gap_days": 7,
            "migration_paused": 0,
        }
        jobs.append(tuple(job.values()))
        full = f"spark_catalog/default/{name}"
        labels[name] = (label, parts)
        commit = commit_rows(rows, full, parts, 10 + n, "1998-06-02 00:00:00", "append")
        ledger = commit if ledger is None else ledger.unionByName(commit)
        log.append((full, 10 + n if label == _SYNCED else 1))
    queue = spark.createDataFrame(jobs, JOB)
    mirrored = spark.createDataFrame(log, "table_name string, snapshot_id bigint").withColumn(
        "mirrored_at", F.lit("1998-06-01 00:00:00").cast("timestamp_ntz")
    )
    sweep.mirror_sweep(spark, queue, pin(ledger, "ledger"), mirrored, AS_OF)

    def counts(suffix):
        out = None
        for name, (label, _) in labels.items():
            one = spark.table(name + suffix).select(F.lit(label).alias("table_name"))
            out = one if out is None else out.unionAll(one)
        return out.groupBy("table_name").agg(F.count(F.lit(1)).alias("record_count"))

    return movement.table_parity(counts(""), counts("_source"))



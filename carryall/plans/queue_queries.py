"""Queries over the job queue: codec, updates, lists and selectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from carryall.functions import sets
from carryall.functions.names import qualified
from carryall.operators import enrich, selectors
from carryall.plans.fixtures import AS_OF, base, fixture, jobs
from carryall.plans.registry import IS_SOURCE, NAME, flat, query, sql_set, sql_text, sql_time
from carryall.schemas import KEY
from carryall.sources import queue

_STAMPS = ["comm_level1_date", "comm_level2_date", "comm_level3_date", "created_at", "last_updated_time"]
_SHORT = ["task_id", *KEY, "state", "desired_state"]
_SHORT_SQL = "task_id, catalog_name, db_name, tbl_name, state, desired_state"


def _whole_job(owners=None, state="state", desired="desired_state", updated="last_updated_time"):
    return f"""task_id, catalog_name, db_name, tbl_name, stg_format, data_category,
 {owners or sql_text(sql_set('tbl_owners'))} tbl_owners, {sql_text(sql_set('downstream_users'))} downstream_users,
 to_be_processed, in_process, {state} state, {desired} desired_state, initial_gap_days, probation_gap_days,
 {sql_time('comm_level1_date')} comm_level1_date, {sql_time('comm_level2_date')} comm_level2_date,
 {sql_time('comm_level3_date')} comm_level3_date, shadow_watermark, migration_paused, pause_reason, run_id,
 shadow_status, {sql_time('created_at')} created_at, {sql_time(updated)} last_updated_time"""


@query("decode_jobs", f"select {_whole_job()} from jobs")
def _(spark, sf):
    return flat(jobs(spark, sf))


@query(
    "encode_jobs",
    f"""select task_id,
 case when len({sql_set('tbl_owners')}) > 0 then cast(to_json({sql_set('tbl_owners')}) as varchar) end tbl_owners,
 case when len({sql_set('downstream_users')}) > 0 then cast(to_json({sql_set('downstream_users')}) as varchar) end downstream_users
 from jobs""",
)
def _(spark, sf):
    return queue.encode_jobs(jobs(spark, sf)).select("task_id", "tbl_owners", "downstream_users")


# Every fourth job is changed; half of the changes are for ids not in the queue.
_CHANGED = "task_id % 8 = 0"


@query(
    "upsert_jobs",
    "select "
    + _whole_job(
        f"case when {_CHANGED} then 'a,z' else {sql_text(sql_set('tbl_owners'))} end",
        f"case when {_CHANGED} then 'READY' else state end",
        f"case when {_CHANGED} then 'LOCKED' else desired_state end",
        f"case when {_CHANGED} then timestamp '{AS_OF}' else last_updated_time end",
    )
    + " from jobs",
)
def _(spark, sf):
    all_jobs = jobs(spark, sf)
    off = F.when(F.col("task_id") % 8 == 4, F.lit(1_000_000_000_000)).otherwise(F.lit(0))
    changes = all_jobs.filter("task_id % 4 = 0").select(
        (F.col("task_id") + off).alias("task_id"),
        *KEY,
        F.lit("READY").alias("state"),
        F.lit("LOCKED").alias("desired_state"),
        sets.literal_set(["z", "a"]).alias("tbl_owners"),
    )
    return flat(queue.upsert_jobs(all_jobs, changes, AS_OF))


def _with_copies(all_jobs):
    again = all_jobs.filter("task_id % 50 = 3").withColumn(
        "task_id", F.col("task_id") + F.lit(1_000_000_000_000)
    )
    return all_jobs.unionByName(again)


@query(
    "duplicate_keys",
    """select catalog_name, db_name, tbl_name, 2 copies from jobs where task_id % 50 = 3""",
)
def _(spark, sf):
    return queue.duplicate_keys(_with_copies(jobs(spark, sf)))


# Names already queued, new ones (each many times over) and malformed lines.
_LINES = """
select catalog_name || '/' || db_name || '/' || tbl_name value_ from jobs
union all select 'newcat/db_' || cast(o_custkey % 30 as varchar(20)) || '/new_' || cast(o_custkey as varchar(20)) || '/' from orders
union all select 'bad_' || cast(o_custkey as varchar(20)) || '/only_two' from orders where o_orderkey % 100 = 0"""


def _lines(spark, sf):
    known = jobs(spark, sf).select(qualified("/").alias("value"))
    cust = base(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("c"))
    new = cust.selectExpr("concat('newcat/db_', c % 30, '/new_', c, '/') value")
    bad = cust.filter("o_orderkey % 100 = 0").selectExpr("concat('bad_', c, '/only_two') value")
    return known.unionAll(new).unionAll(bad)


@query(
    "ingest_tables",
    f"""with lines as ({_LINES}),
fresh as (select distinct split_part(value_, '/', 1) c, split_part(value_, '/', 2) d, split_part(value_, '/', 3) t
 from lines where value_ like 'newcat/%'),
top as (select max(task_id) m from jobs)
select m + row_number() over (order by substr(md5(c || chr(1) || d || chr(1) || t), 1, 3), c, d, t) task_id,
 c catalog_name, d db_name, t tbl_name, cast(null as varchar) stg_format, 'UNKNOWN' data_category,
 '' tbl_owners, '' downstream_users, 0 to_be_processed, 0 in_process, 'NEW' state, 'NEW' desired_state,
 14 initial_gap_days, 0 probation_gap_days, cast(null as varchar) comm_level1_date,
 cast(null as varchar) comm_level2_date, cast(null as varchar) comm_level3_date,
 cast(null as bigint) shadow_watermark, 0 migration_paused, 'None' pause_reason, cast(null as varchar) run_id,
 cast(null as varchar) shadow_status, '{AS_OF}' created_at, '{AS_OF}' last_updated_time
from fresh, top""",
)
def _(spark, sf):
    return flat(queue.ingest_tables(_lines(spark, sf), jobs(spark, sf), AS_OF)[0])


@query("ingest_rejects", f"with lines as ({_LINES}) select value_ line from lines where value_ like 'bad%'")
def _(spark, sf):
    return queue.ingest_tables(_lines(spark, sf), jobs(spark, sf), AS_OF)[1]


def _named(spark, sf):
    """Names of some queued tables, with repeats, and of as many unknown ones."""
    orders = base(spark, sf, "orders")
    listed = jobs(spark, sf).join(
        orders.select(F.col("o_custkey").alias("task_id")), "task_id", "left_semi"
    )
    unknown = listed.select("catalog_name", "db_name", F.concat("tbl_name", F.lit("_x")).alias("tbl_name"))
    return listed.select(*KEY).unionAll(listed.select(*KEY)).unionAll(unknown)


@query(
    "remove_jobs",
    f"select {_SHORT_SQL} from jobs where task_id not in (select o_custkey from orders)",
)
def _(spark, sf):
    return queue.remove_jobs(jobs(spark, sf), _named(spark, sf)).select(*_SHORT)


@query(
    "lookup_jobs",
    f"select {_SHORT_SQL} from jobs where task_id in (select o_custkey from orders)",
)
def _(spark, sf):
    return queue.lookup_jobs(jobs(spark, sf), _named(spark, sf)).select(*_SHORT)


@query(
    "missing_keys",
    """select catalog_name, db_name, tbl_name || '_x' tbl_name from jobs
 where task_id in (select o_custkey from orders)""",
)
def _(spark, sf):
    return queue.missing_keys(jobs(spark, sf), _named(spark, sf))


@query(
    "read_table_list",
    """select catalog_name, db_name, tbl_name from jobs
union all select distinct 'cat', 'db', 'cust_' || cast(o_custkey as varchar(20)) from orders""",
)
def _(spark, sf):
    dotted = jobs(spark, sf).select(F.concat(F.lit("  "), F.upper(qualified(".")), F.lit(" ")).alias("n"))
    more = base(spark, sf, "orders").select(F.col("o_custkey").alias("c"))
    lines = dotted.select(F.concat("n", F.lit(",just.two")).alias("value")).unionAll(
        more.selectExpr("concat('Cat.DB.cust_', c) value")
    )
    return queue.read_table_list(lines)[0]


@query("read_table_list_rejects", "select 'just.two' line from jobs")
def _(spark, sf):
    names = jobs(spark, sf).select(F.concat(qualified("."), F.lit(",just.two")).alias("value"))
    return queue.read_table_list(names)[1]


@query("read_slash_list", "select catalog_name, db_name, upper(tbl_name) tbl_name from jobs")
def _(spark, sf):
    names = jobs(spark, sf).withColumn("tbl_name", F.upper("tbl_name")).select(qualified("/").alias("value"))
    return queue.read_table_list(names, "/")[0]


_ACTIVE = "migration_paused = 0"
PREPROCESS_DUE = f"""{_ACTIVE} and ((to_be_processed = 0 and in_process = 0 and state = 'NEW' and desired_state = 'NEW')
 or (in_process = 1 and state = 'OPEN' and desired_state = 'OPEN'
     and comm_level2_date < timestamp '{AS_OF}' - to_days(probation_gap_days))
 or (in_process = 1 and state = 'SOURCE_ARCHIVED' and desired_state = 'SOURCE_ARCHIVED'))"""


@query("select_preprocess", f"select {_SHORT_SQL} from jobs where {PREPROCESS_DUE}")
def _(spark, sf):
    return selectors.select_preprocess(jobs(spark, sf), AS_OF).select(*_SHORT)


def _shard_sql(n: int, column: str = "task_id") -> str:
    chunk = lambda i: f"('0x' || substr(md5(cast({column} as varchar)), {i}, 8))::ubigint"
    rest = f"({chunk(1)} % {n})"
    for i in (9, 17, 25):
        rest = f"(({rest} * 4294967296 + {chunk(i)}) % {n})"
    return f"cast({rest} + 1 as int)"


@query(
    "select_preprocess_batch",
    f"""select {_SHORT_SQL} from jobs where {PREPROCESS_DUE} and {_shard_sql(3)} = 2
 order by task_id limit 500""",
)
def _(spark, sf):
    return selectors.select_preprocess(jobs(spark, sf), AS_OF, limit=500, shard=(2, 3)).select(*_SHORT)


@query(
    "select_notify",
    f"""select {_SHORT_SQL} from jobs where {_ACTIVE} and ((to_be_processed = 1 and comm_level1_date is null)
 or (in_process = 1 and comm_level1_date is not null and state = 'OPEN' and desired_state = 'OPEN'
     and comm_level2_date is null)
 or (in_process = 0 and comm_level2_date is not null and state = 'SOURCE_ARCHIVED'
     and desired_state = 'SOURCE_ARCHIVED' and comm_level3_date is null))""",
)
def _(spark, sf):
    return selectors.select_notify(jobs(spark, sf)).select(*_SHORT)


_MIGRATE = f"""{_ACTIVE} and ((to_be_processed = 1 and comm_level1_date is not null
     and comm_level1_date < timestamp '{AS_OF}' - to_days(initial_gap_days)
     and state = 'READY' and desired_state = 'LOCKED')
 or (in_process = 1 and state <> desired_state))"""


@query("select_migrate", f"select {_SHORT_SQL} from jobs where {_MIGRATE}")
def _(spark, sf):
    return selectors.select_migrate(jobs(spark, sf), AS_OF).select(*_SHORT)


@query(
    "select_mirror",
    f"""select {_SHORT_SQL} from jobs where {_ACTIVE} and state = 'OPEN' and desired_state = 'OPEN'
 and probation_gap_days > 0 and shadow_status is null""",
)
def _(spark, sf):
    return selectors.select_mirror(jobs(spark, sf)).select(*_SHORT)


def _revert(spark, sf, **options):
    all_jobs = _with_copies(jobs(spark, sf))
    kinds = enrich.classify_kind(all_jobs, fixture(spark, sf, "catalog"))
    return selectors.select_revert(kinds, _named(spark, sf), **options)


_REVERT_CHECK = f"""select {_SHORT_SQL} from jobs j join (select {', '.join(KEY)}, {IS_SOURCE} src from catalog) c
 using ({', '.join(KEY)})
 where task_id in (select o_custkey from orders) and task_id % 50 <> 3 and not src"""


@query("select_revert", _REVERT_CHECK)
def _(spark, sf):
    return _revert(spark, sf)[0].select(*_SHORT)


@query(
    "select_revert_in_probation",
    _REVERT_CHECK + " and state = 'OPEN' and desired_state = 'OPEN' and in_process = 1 and probation_gap_days > 0",
)
def _(spark, sf):
    return _revert(spark, sf, require_probation=True)[0].select(*_SHORT)


@query(
    "select_revert_rejects",
    """select catalog_name, db_name, tbl_name, 2 matches, 'ambiguous table' reason from jobs
 where task_id in (select o_custkey from orders) and task_id % 50 = 3
union all select catalog_name, db_name, tbl_name || '_x', 0, 'unknown table' from jobs
 where task_id in (select o_custkey from orders)""",
)
def _(spark, sf):
    return _revert(spark, sf)[1]


@query(
    "filter_batch",
    f"""select {_SHORT_SQL} from jobs where lower({NAME}) in
 (select lower(table_name) from batches where batchId = 'wave_a')""",
)
def _(spark, sf):
    batches = fixture(spark, sf, "batches")
    return selectors.filter_batch(jobs(spark, sf), batches, "WAVE_A").select(*_SHORT)


@query(
    "assign_shard",
    f"""select task_id, {_shard_sql(1)} shard_1, {_shard_sql(3)} shard_3, {_shard_sql(7)} shard_7,
 {_shard_sql(16)} shard_16 from jobs""",
)
def _(spark, sf):
    out = jobs(spark, sf).select("task_id")
    for n in (1, 3, 7, 16):
        out = selectors.assign_shard(out, n).withColumnRenamed("shard", f"shard_{n}")
    return out

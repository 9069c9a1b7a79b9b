"""Control tables derived from the given test tables.

Each fixture is one SQL text that Spark and the checking engine both run, so the
two sides start from equal rows. A fixture may build on earlier ones.
"""

from __future__ import annotations

import functools
import re

from pyspark.sql import DataFrame, SparkSession

from carryall.sources.queue import decode_jobs

AS_OF = "1998-07-01 00:00:00"
DAY_KEY = 20240131
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

_FIXTURES = {
    # The queue as stored: sets are JSON text, absent values NULL.
    "queue": """
select cast(o_orderkey as bigint) task_id,
 case when o_orderkey % 10 = 9 then 'testcat' else 'prodcat' end catalog_name,
 concat(case when o_orderkey % 8 = 0 then 'ae_' else 'db_' end, cast(o_orderkey % 20 as varchar(20))) db_name,
 concat('table_', cast(o_orderkey as varchar(20))) tbl_name,
 case when o_orderkey % 10 = 0 then null when o_orderstatus = 'P' then 'csv/text' else 'parquet' end stg_format,
 case when o_orderkey % 6 <> 0 then 'UNKNOWN' end data_category,
 case when o_orderkey % 7 = 0 then null
      when o_orderkey % 7 = 1 then '["guest"]'
      when o_orderkey % 7 = 2 then concat('["owner_', cast(o_custkey % 50 as varchar(20)), '@example.com","owner_0@example.com","owner_0@example.com"]')
      else concat('["owner_', cast(o_custkey % 50 as varchar(20)), '@example.com"]') end tbl_owners,
 case when o_orderkey % 5 = 0 then null
      when o_orderkey % 5 = 1 then concat('["reader_', cast(o_custkey as varchar(20)), '@example.com","table_scanner@example.com","someone"]')
      else concat('["reader_', cast(o_custkey as varchar(20)), '@example.com","owner_', cast(o_custkey % 50 as varchar(20)), '@example.com"]') end downstream_users,
 case when o_orderkey % 10 in (1,2,3,4) then 1 else 0 end to_be_processed,
 case when o_orderkey % 10 in (5,6,7,8) then 1 else 0 end in_process,
 case when o_orderkey % 20 = 10 then null when o_orderkey % 10 = 0 then 'NEW' when o_orderkey % 10 <= 4 then 'READY'
      when o_orderkey % 10 = 5 then 'LOCKED' when o_orderkey % 10 <= 7 then 'OPEN'
      else 'SOURCE_ARCHIVED' end state,
 case when o_orderkey % 10 = 0 then 'NEW' when o_orderkey % 10 <= 4 then 'LOCKED'
      when o_orderkey % 10 = 5 then 'COPIED' when o_orderkey % 10 <= 7 then 'OPEN'
      else 'SOURCE_ARCHIVED' end desired_state,
 case when o_orderkey % 10 in (1,2) then cast(o_custkey % 3 as int) else 14 end initial_gap_days,
 cast(o_custkey % 3 * 7 as int) probation_gap_days,
 case when o_orderkey % 10 >= 3 then o_orderdate end comm_level1_date,
 case when o_orderkey % 10 >= 7 and o_orderkey % 40 <> 7 then o_orderdate + interval '20' day end comm_level2_date,
 cast(null as timestamp) comm_level3_date,
 case when o_orderkey % 4 = 0 then cast(o_custkey as varchar(20)) end shadow_watermark,
 case when o_orderpriority = '5-LOW' then 1 else 0 end migration_paused,
 case when o_orderkey % 9 <> 0 then 'None' end pause_reason,
 case when o_orderkey % 4 = 1 then 'run_1' end run_id,
 case when o_custkey % 5 = 0 then 'MIRRORING' end shadow_status,
 o_orderdate created_at, o_orderdate last_updated_time
from orders""",
    # The decoded queue without the set columns, for the checking engine.
    "jobs": """
select task_id, catalog_name, db_name, tbl_name, coalesce(stg_format, '') stg_format,
 coalesce(data_category, '') data_category, tbl_owners, downstream_users,
 to_be_processed, in_process, coalesce(state, 'NEW') state, desired_state,
 initial_gap_days, probation_gap_days, comm_level1_date, comm_level2_date, comm_level3_date,
 cast(shadow_watermark as bigint) shadow_watermark, migration_paused,
 coalesce(pause_reason, 'None') pause_reason, run_id, shadow_status, created_at, last_updated_time
from queue""",
    # Changes by several writers; one in four was made from an older row, one in five is for another name.
    "changes": """
select distinct task_id, catalog_name, db_name, case when l_linenumber % 5 = 0 then 'gone' else tbl_name end tbl_name,
 'READY' state, concat('run_', cast(l_linenumber as varchar(20))) run_id,
 cast(case when l_linenumber % 4 = 0 then task_id % 3 + 1 else task_id % 3 end as bigint) version,
 l_shipdate + interval '1' second * l_linenumber changed_at
from jobs j join lineitem l on task_id = l_orderkey""",
    # One table has a third of all reads.
    "lineage": """
select concat(case when k % 10 = 9 then 'testcat' else 'prodcat' end, '/',
  case when k % 8 = 0 then 'ae_' else 'db_' end, cast(k % 20 as varchar(20)),
  '/table_', cast(k as varchar(20))) source_name,
 case when event_type in ('view','click') then 'read' else 'write' end operation,
 case when user_id % 2 = 0 then concat('user_', cast(user_id as varchar(20)))
      else concat('user_', cast(user_id as varchar(20)), '@example.com') end user_id,
 cast(ts as date) as day
from (select *, case when event_id % 3 = 0 then 7 else event_id % 1500 end k from events) e""",
    "catalog": """
select catalog_name, db_name, tbl_name,
 case when task_id % 7 = 0 then 'ICEBERG' when task_id % 7 = 1 then 'EXTERNAL_TABLE' end table_type,
 case when task_id % 7 = 2 then 'http://serde/other' when task_id % 7 = 3 and task_id % 2 = 0 then null
      else 'http://serde/hive' end serde_uri,
 case when task_id % 3 = 0 then 'org.x.TextOutputFormat' else 'org.x.MapredParquetOutputFormat' end output_format,
 case when task_id % 19 <> 0 then concat('file:/warehouse/t', cast(task_id as varchar(20))) end data_uri,
 case when task_id % 11 = 0 then 0 when task_id % 11 = 1 then null else task_id end data_size,
 case when task_id % 4 = 0 then null when task_id % 4 = 1 then split('do_not_rename,team_a', ',')
      when task_id % 4 = 2 then split('migration_do_not_modify,team_b', ',')
      else split('do_not_drop,do_not_rename,team_c', ',') end tags,
 concat('u', cast(task_id % 40 as varchar(20))) owner_user_id,
 task_id % 6 = 0 secure,
 case when task_id % 23 = 0 then concat('file:/older/t', cast(task_id as varchar(20))) end migrated_data_location,
 case when task_id % 13 = 0 then 'timestamp' else 'c1' end col_name,
 case when task_id % 5 = 0 then 'timestamp' when task_id % 5 = 1 then 'struct<timestamp:bigint>'
      when task_id % 5 = 2 then 'array<TIMESTAMP>' else 'bigint' end col_type,
 case when task_id % 29 = 0 then 'timestamp' when task_id % 31 <> 0 then 'string' end more_type
from jobs where task_id % 17 <> 0""",
    # The catalogue with renamed relatives of some tables.
    "fleet": """
select catalog_name, db_name, tbl_name, table_type, serde_uri, data_uri, data_size, tags,
 owner_user_id, secure, migrated_data_location
from catalog
""" + "".join(
        f"""
union all
select catalog_name, db_name, concat(tbl_name, '{suffix}') tbl_name, '{kind}' table_type,
 'http://serde/hive' serde_uri,
 case when task_id % 21 <> 0 then concat('file:/kept/t', cast(task_id as varchar(20)), '{suffix}') end data_uri,
 task_id * 2 data_size,
 case when task_id % 16 = 0 then null when task_id % 3 = 0 then split('do_not_drop,do_not_rename,migration_do_not_modify', ',')
      else split('team_d,h1', ',') end tags,
 concat('v', cast(task_id % 40 as varchar(20))) owner_user_id,
 case when task_id % 2 = 0 then true end secure,
 case when task_id % 24 = 0 then concat('file:/first/t', cast(task_id as varchar(20))) end migrated_data_location
from jobs where task_id % {every} = 0"""
        for suffix, kind, every in (
            ("_source", "EXTERNAL_TABLE", 4),
            ("_target", "ICEBERG", 5),
            ("_source_archived", "EXTERNAL_TABLE", 6),
            ("_target_archived", "ICEBERG", 9),
            ("_target_revert", "ICEBERG", 10),
        )
    ),
    "contacts": """
select concat(catalog_name,'/',db_name,'/',tbl_name) table_name,
 case when task_id % 4 = 0 then 'core_pi' when task_id % 4 in (1,2) then 'pi' else 'other' end tag_key,
 case when task_id % 4 = 1 then 'yes' when task_id % 4 = 2 then 'no' else 'x' end tag_value,
 case when task_id % 5 = 0 then ''
      else concat('owner_', cast(task_id % 50 as varchar(20)), '@example.com,lead@example.com') end contact
from jobs where task_id % 3 = 0""",
    "meta_daily": """
select concat(catalog_name,'/',db_name,'/',tbl_name) table_name,
 case when task_id % 11 = 1 then '' else concat('daily_', cast(task_id % 30 as varchar(20)), '@example.com') end contact,
 case when task_id % 2 = 0 then 20240131 else 20240130 end dateint
from jobs where task_id % 3 in (0, 1)""",
    # Two documents per table; the later one has the right owner, or none.
    "meta_events": " union all ".join(
        f"""
select concat(catalog_name,'/',db_name,'/',tbl_name) table_name, created_at + interval '{later}' day event_time,
 case when task_id % 35 = 1 then '{{"definitionMetadata":{{}}}}' when task_id % 35 = 2 then '' else
 concat('{{"definitionMetadata":{{"owner":{{"userId":"{tag}', cast(task_id % 40 as varchar(20)), '"}}}}}}') end current_json
from jobs where task_id % 5 <> 0"""
        for tag, later in (("old", 0), ("u", 1))
    ),
    "batches": """
select case when task_id % 2 = 0 then upper(concat(catalog_name,'/',db_name,'/',tbl_name))
            else concat(catalog_name,'/',db_name,'/',tbl_name) end table_name,
 case when task_id % 3 = 0 then 'wave_a' when task_id % 3 = 1 then 'Wave_A' else 'wave_b' end batchId
from jobs""",
    "ledger": """
select concat('prodcat/db_', cast(event_id % 20 as varchar(20)), '/table_', cast(k as varchar(20))) table_name,
 event_id * 7919 % 1000003 snapshot_id, ts committed_at, 'append' operation,
 concat('p', cast(user_id % 10 as varchar(20))) part, cast(floor(value) as bigint) record_count
from (select *, case when event_id % 3 = 0 then 0 else event_id % 100 end k from events) e""",
    # The snapshot each table was last mirrored at; some are unknown to the ledger.
    "mirror_log": """
select table_name, case when n % 5 = 0 then -7 else snapshot_id end snapshot_id, committed_at mirrored_at
from (select *, row_number() over (partition by table_name order by committed_at, snapshot_id) n from ledger) l
where n <= 3""",
}


# Fixtures that join a large table: the key of each input. Both sides are dealt to parts of a
# bounded number of rows, so that what a task sorts and makes distinct does not grow with them.
_DEALT = {"changes": {"lineitem": "l_orderkey", "jobs": "task_id"}}
_PART_ROWS = 200_000


def _n_parts(rows: int) -> int | None:
    return n if (n := rows // _PART_ROWS) >= 2 else None


def parts_of(spark: SparkSession, sf_dir: str, name: str) -> int | None:
    """Parts for a join of a dealt fixture; None for a small one. Rows are counted from footers."""
    return _n_parts(base(spark, sf_dir, next(iter(_DEALT[name]))).count())


def _dealt(inputs: dict[str, DataFrame], keys: dict[str, str]) -> dict[str, DataFrame]:
    """The inputs in parts by their key; the rows of the first named are counted from its footers."""
    n = _n_parts(inputs[next(iter(keys))].count())
    if n is None:
        return inputs
    return {name: df.repartition(n, keys[name]) if name in keys else df for name, df in inputs.items()}


# Plans (not data) of the fixtures already built in a session.
_built: dict[tuple, DataFrame] = {}


def base(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A given table; its files are listed once per session."""
    return _once(spark, sf_dir, table, lambda: spark.read.parquet(f"{sf_dir}/{table}.parquet"))


def _once(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    key = (spark.sparkContext.applicationId, id(spark), sf_dir, name)
    if key not in _built:
        _built[key] = build()
    return _built[key]


def _used(text: str) -> list[str]:
    words = set(re.findall(r"\b(?:from|join)\s+(\w+)", text))
    return [n for n in (*TABLES, *_FIXTURES) if n in words]


@functools.lru_cache(maxsize=None)
def _needed(name: str) -> tuple[str, ...]:
    order: list[str] = []
    for used in _used(_FIXTURES[name]):
        if used in _FIXTURES:
            for deeper in (*_needed(used), used):
                if deeper not in order:
                    order.append(deeper)
    return tuple(order)


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture (or given table) as a DataFrame."""
    if name not in _FIXTURES:
        return base(spark, sf_dir, name)

    def build():
        text = _FIXTURES[name]
        inputs = {used: fixture(spark, sf_dir, used) for used in _used(text)}
        if name in _DEALT:
            inputs = _dealt(inputs, _DEALT[name])
        text = text.replace("{", "{{").replace("}", "}}")
        for used in inputs:
            text = re.sub(rf"\b(from|join)\s+{used}\b", rf"\1 {{{used}}}", text)
        return spark.sql(text, **inputs)

    return _once(spark, sf_dir, name, build)


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The decoded queue."""
    return _once(
        spark, sf_dir, "decoded queue", lambda: decode_jobs(fixture(spark, sf_dir, "queue"))
    )


def with_fixtures(sql: str) -> str:
    """The checking query, preceded by the fixtures it names."""
    order: list[str] = []
    for used in _used(sql):
        if used in _FIXTURES:
            for name in (*_needed(used), used):
                if name not in order:
                    order.append(name)
    ctes = [f"{name} as ({_FIXTURES[name].strip()})" for name in order]
    sql = sql.strip()
    if not ctes:
        return sql
    if sql.lower().startswith("with recursive"):
        return "with recursive " + ",\n".join(ctes) + ",\n" + sql[len("with recursive") :].strip()
    if sql.lower().startswith("with "):
        return "with " + ",\n".join(ctes) + ",\n" + sql[5:].strip()
    return "with " + ",\n".join(ctes) + "\n" + sql

"""Queries that decide the next state of jobs."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from carryall import vocabulary as v
from carryall.operators import catalog as cat
from carryall.operators import enrich, lifecycle, selectors
from carryall.plans.enrich_queries import (
    CATEGORY,
    HAS_TS,
    OWNERS,
    READERS,
    catalog,
    category_metadata,
    empty_tables,
    owner_sources,
    reader_columns,
)
from carryall.plans.fixtures import AS_OF, DAY_KEY, fixture, jobs
from carryall.plans.registry import EMPTY_TABLES, IS_SOURCE, NAME, flat, query, sql_set, sql_text
from carryall.plans.queue_queries import PREPROCESS_DUE
from carryall.plans.runs import migrate_plan, preprocess_plan
from carryall.schemas import KEY

# The databases of the fixture whose tables are always rewritten.
_OWN = replace(v.DEFAULT, rewrite_db_prefixes=("ae_",))

_KEY_SQL = ", ".join(KEY)
_STATE = ["task_id", "to_be_processed", "in_process", "state", "desired_state", "migration_paused", "pause_reason"]

_FRESH = "(to_be_processed = 0 and in_process = 0 and state = 'NEW' and desired_state = 'NEW')"


_PREPROCESSED = f"""with owners as ({OWNERS}), readers as ({READERS}),
sets as (select source_name, list_sort(list(downstream_user)) users from readers group by source_name),
facts as (select {_KEY_SQL}, {IS_SOURCE} src,
 case when lower(output_format) like '%parquet%' then 'parquet' else 'csv/text' end fmt from catalog),
j as (select jobs.*, {_FRESH} and src is not null found, {_FRESH} and src is null gone, src, fmt,
  {CATEGORY} category, owners, users
 from jobs left join facts using ({_KEY_SQL}) left join contacts c on c.table_name = {NAME}
 left join owners o on o.table_name = {NAME} left join sets s on s.source_name = {NAME})
select task_id, case when found then fmt else stg_format end stg_format,
 case when found then category else data_category end data_category,
 {sql_text(f"case when found and len({sql_set('tbl_owners')}) = 0 then coalesce(owners, []) else {sql_set('tbl_owners')} end")} tbl_owners,
 {sql_text(f"case when found and len({sql_set('downstream_users')}) = 0 then coalesce(users, []) else {sql_set('downstream_users')} end")} downstream_users,
 case when found and src then 1 else to_be_processed end to_be_processed,
 case when in_process = 1 and state = 'SOURCE_ARCHIVED' and desired_state = 'SOURCE_ARCHIVED' then 0 else in_process end in_process,
 case when found and src then 'READY' else state end state,
 case when found and src then 'LOCKED' when in_process = 1 and state = 'OPEN' and desired_state = 'OPEN'
  then 'SOURCE_ARCHIVED' else desired_state end desired_state,
 case when gone or (found and not src) then 1 else migration_paused end migration_paused,
 case when gone then 'TABLE_NOT_FOUND' when found and not src then 'ALREADY_TARGET' else pause_reason end pause_reason
from j"""


@query("preprocess_step", _PREPROCESSED)
def _(spark, sf):
    sources = owner_sources(spark, sf)
    owners = enrich.owner_candidates(*sources, DAY_KEY)
    sets = reader_columns(spark, sf)
    out = lifecycle.preprocess_step(
        jobs(spark, sf), catalog(spark, sf), category_metadata(spark, sf), owners, sets
    )
    return flat(
        out.select("task_id", "stg_format", "data_category", "tbl_owners", "downstream_users", *_STATE[1:])
    )


@query(
    "preprocess_plan",
    f"{_PREPROCESSED} where task_id in (select task_id from jobs where {PREPROCESS_DUE})",
)
def _(spark, sf):
    out, _ = preprocess_plan(
        jobs(spark, sf),
        catalog(spark, sf),
        category_metadata(spark, sf),
        *owner_sources(spark, sf),
        fixture(spark, sf, "lineage"),
        AS_OF,
        DAY_KEY,
    )
    return flat(
        out.select("task_id", "stg_format", "data_category", "tbl_owners", "downstream_users", *_STATE[1:])
    )


_GATE = f"""with empty_tables as ({EMPTY_TABLES}),
f as (select {_KEY_SQL}, {IS_SOURCE} src from fleet),
names as (select distinct catalog_name c, db_name d, tbl_name t from fleet),
k as (select j.catalog_name, j.db_name, j.tbl_name, true kept from jobs j
 join names on c = j.catalog_name and d = j.db_name and t = j.tbl_name || '_source'),
j as (select jobs.*, coalesce(src, false) is_source, src is null and kept is null gone,
 stg_format = 'parquet' or task_id in (select task_id from empty_tables) copyable
 from jobs left join f using ({_KEY_SQL}) left join k using ({_KEY_SQL})),
gated as (select *, case when gone then 'TABLE_NOT_FOUND' when to_be_processed = 0 then null
 when not is_source then 'ALREADY_TARGET' when not copyable then 'TEXT_FORMAT' end why from j)"""


@query(
    "migrate_gate",
    _GATE
    + """ select task_id,
 case when not gone and why is null and to_be_processed = 1 then 0 else to_be_processed end to_be_processed,
 case when not gone and why is null and to_be_processed = 1 then 1 else in_process end in_process,
 state, desired_state, case when why is not null then 1 else migration_paused end migration_paused,
 coalesce(why, pause_reason) pause_reason, case when why is null then 'go' else 'hold' end gate, is_source from gated""",
)
def _(spark, sf):
    out = lifecycle.migrate_gate(jobs(spark, sf), fixture(spark, sf, "fleet"), empty_tables(spark, sf))
    return out.select(*_STATE, "gate", "is_source")


@query(
    "migrate_gate_with_text",
    _GATE
    + """ select task_id, case when why is null or why = 'TEXT_FORMAT' then 'go' else 'hold' end gate from gated""",
)
def _(spark, sf):
    out = lifecycle.migrate_gate(
        jobs(spark, sf), fixture(spark, sf, "fleet"), empty_tables(spark, sf), allow_text=True
    )
    return out.select("task_id", "gate")


@query(
    "copy_strategy",
    f"""with empty_tables as ({EMPTY_TABLES}), ts as (select {_KEY_SQL}, {HAS_TS} has_ts from catalog),
j as (select jobs.*, (stg_format = 'parquet' and db_name not like 'ae\\_%' escape '\\' and not coalesce(has_ts, false))
  or task_id in (select task_id from empty_tables) snap from jobs left join ts using ({_KEY_SQL}))
select task_id, case when snap then stg_format else 'csv/text' end stg_format,
 case when snap then 'SNAPSHOT' else 'REWRITE' end strategy from j""",
)
def _(spark, sf):
    out = lifecycle.copy_strategy(jobs(spark, sf), catalog(spark, sf), empty_tables(spark, sf), names=_OWN)
    return out.select("task_id", "stg_format", "strategy")


# The transition table once more, by hand: state, desired, action, then forward and revert.
_MOVES = """moves(s, d, action, fs, fd, rs, rd) as (values
 ('READY','LOCKED','lock','LOCKED','COPIED','LOCKED','SYNCED_BACK'),
 ('LOCKED','COPIED','copy','COPIED','TARGET_PRIMARY','COPIED','TARGET_PRIMARY'),
 ('COPIED','TARGET_PRIMARY','promote','TARGET_PRIMARY','OPEN','TARGET_PRIMARY','OPEN'),
 ('TARGET_PRIMARY','OPEN','unlock','OPEN','OPEN','OPEN','TARGET_RETIRED'),
 ('OPEN','LOCKED','lock','LOCKED','COPIED','LOCKED','SYNCED_BACK'),
 ('LOCKED','SYNCED_BACK','mirror_back','SYNCED_BACK','SOURCE_PRIMARY','SYNCED_BACK','SOURCE_PRIMARY'),
 ('SYNCED_BACK','SOURCE_PRIMARY','restore','SOURCE_PRIMARY','OPEN','SOURCE_PRIMARY','OPEN'),
 ('SOURCE_PRIMARY','OPEN','unlock','OPEN','OPEN','OPEN','TARGET_RETIRED'),
 ('OPEN','TARGET_RETIRED','retire_target','TARGET_RETIRED','TARGET_RETIRED','TARGET_RETIRED','TARGET_RETIRED'),
 ('OPEN','SOURCE_ARCHIVED','archive_source','SOURCE_ARCHIVED','SOURCE_ARCHIVED','SOURCE_ARCHIVED','SOURCE_ARCHIVED'))"""

# Jobs spread over all start pairs; one in seven has moved already.
_START = (
    "start(task_id, s, d, moved) as (select task_id, s, d, task_id % 7 = 0 from jobs join "
    "(select *, row_number() over (order by s, d) - 1 k from moves) m on k = task_id % 10)"
)


def _started(spark, sf):
    pairs = sorted((s, d) for s, d, *_ in v.TRANSITIONS)
    state = F.lit(None).cast("string")
    desired = F.lit(None).cast("string")
    for k, (s, d) in enumerate(pairs):
        here = F.col("task_id") % 10 == k
        state, desired = F.when(here, s).otherwise(state), F.when(here, d).otherwise(desired)
    return jobs(spark, sf).withColumns(
        {
            "state": state,
            "desired_state": desired,
            "is_source": F.col("task_id") % 7 != 0,
            "migration_paused": F.lit(0),
            "pause_reason": F.lit(v.NOT_PAUSED),
        }
    )


def _next_sql(flow: str) -> str:
    return f"""with {_MOVES} select task_id, state, desired_state, action, {flow}s next_state, {flow}d next_desired
 from jobs left join moves on s = state and d = desired_state"""


@query("next_action", _next_sql("f"))
def _(spark, sf):
    out = lifecycle.next_action(jobs(spark, sf))
    return out.select("task_id", "state", "desired_state", "action", "next_state", "next_desired")


@query(
    "next_action_all_pairs",
    f"""with {_MOVES}, {_START} select task_id, action, rs next_state, rd next_desired
 from start join moves using (s, d)""",
)
def _(spark, sf):
    out = lifecycle.next_action(_started(spark, sf), v.REVERT)
    return out.select("task_id", "action", "next_state", "next_desired")


def _walk_sql(flow: str) -> str:
    return f"""with recursive {_MOVES}, {_START},
walk(task_id, s, d, moved, n, path, stop) as (
 select task_id, s, d, moved, 0, '', false from start
 union all
 select w.task_id, case when moved and action = 'copy' then 'READY' else {flow}s end,
  case when moved and action = 'copy' then 'LOCKED' else {flow}d end, moved, n + 1,
  path || case when n = 0 then '' else ',' end || case when moved and action = 'copy' then 'refuse_copy' else action end,
  moved and action = 'copy'
 from walk w join moves m on w.s = m.s and w.d = m.d where not stop)
select task_id, max_by(s, n) state, max_by(d, n) desired_state, max_by(path, n) actions,
 cast(max_by(stop, n) as int) migration_paused,
 case when max_by(stop, n) then 'ALREADY_TARGET' else 'None' end pause_reason
from walk group by task_id"""


_WALKED = ["task_id", "state", "desired_state", "actions", "migration_paused", "pause_reason"]


@query("advance_jobs", _walk_sql("f"))
def _(spark, sf):
    return flat(lifecycle.advance_jobs(_started(spark, sf)).select(*_WALKED))


@query("advance_jobs_revert", _walk_sql("r"))
def _(spark, sf):
    return flat(lifecycle.advance_jobs(_started(spark, sf), v.REVERT).select(*_WALKED))


@query(
    "revert_step",
    f"""select task_id, 'TARGET_RETIRED' state, 'TARGET_RETIRED' desired_state,
 'lock,mirror_back,restore,unlock,retire_target' actions, 1 migration_paused, 'REVERTED' pause_reason
 from jobs join (select {_KEY_SQL}, {IS_SOURCE} src from catalog) c using ({_KEY_SQL}) where not src""",
)
def _(spark, sf):
    kinds = enrich.classify_kind(jobs(spark, sf), fixture(spark, sf, "catalog"))
    picked, _ = selectors.select_revert(kinds, jobs(spark, sf).select(*KEY))
    return flat(lifecycle.revert_step(picked).select(*_WALKED))


@query(
    "revert_finalized_step",
    f"""select task_id, 1 to_be_processed, 0 in_process, 'READY' state, 'LOCKED' desired_state,
 1 migration_paused, 'REVERTED' pause_reason
 from jobs join (select {_KEY_SQL}, {IS_SOURCE} src from fleet) c using ({_KEY_SQL})
 where not src and task_id % 6 = 0""",
)
def _(spark, sf):
    all_jobs = jobs(spark, sf)
    _, outcome = cat.swap_back_finalized(all_jobs, fixture(spark, sf, "fleet"))
    return lifecycle.revert_finalized_step(all_jobs, outcome).select(*_STATE)


@query(
    "migrate_plan",
    _GATE
    + f""", ts as (select {_KEY_SQL}, {HAS_TS} has_ts from catalog),
due as (select gated.*, (stg_format = 'parquet' and db_name not like 'ae\\_%' escape '\\' and not coalesce(has_ts, false))
  or task_id in (select task_id from empty_tables) snap
 from gated left join ts using ({_KEY_SQL}) where migration_paused = 0 and
 ((to_be_processed = 1 and comm_level1_date < timestamp '{AS_OF}' - to_days(initial_gap_days) and state = 'READY'
   and desired_state = 'LOCKED') or (in_process = 1 and state <> desired_state)))
select task_id, why is null "go", case when why is not null or not is_source then null when snap then 'SNAPSHOT' else 'REWRITE' end strategy,
 case when why is not null or not is_source or snap then stg_format else 'csv/text' end stg_format,
 case when why is not null then state when not is_source then 'READY' else 'OPEN' end state,
 case when why is not null then desired_state when not is_source then 'LOCKED' else 'OPEN' end desired_state,
 case when why is not null then '' when state = 'LOCKED' and not is_source then 'refuse_copy'
  when state = 'LOCKED' then 'copy,promote,unlock' else 'lock,copy,promote,unlock' end actions,
 cast(why is not null or not is_source as int) migration_paused,
 coalesce(why, case when not is_source then 'ALREADY_TARGET' end, pause_reason) pause_reason from due""",
)
def _(spark, sf):
    out = migrate_plan(
        jobs(spark, sf),
        fixture(spark, sf, "fleet").join(catalog(spark, sf).select(*KEY, "fields"), KEY, "left"),
        empty_tables(spark, sf),
        AS_OF,
        names=_OWN,
    )
    return flat(out.select(*_WALKED, "strategy", "stg_format", (F.col("gate") == "go").alias("go")))

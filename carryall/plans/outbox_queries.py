"""Queries that decide on and render notifications."""

from __future__ import annotations

from pyspark.sql import functions as F

from carryall import vocabulary as v
from carryall.operators import enrich, outbox, selectors
from carryall.plans.enrich_queries import empty_tables
from carryall.plans.fixtures import AS_OF, fixture, jobs
from carryall.plans.registry import EMPTY_TABLES, IS_SOURCE, flat, query, sql_set, sql_text, sql_time
from carryall.plans.runs import notify_plan
from carryall.schemas import KEY
from carryall.sources.tables import pin

_KEY_SQL = ", ".join(KEY)


def _mails(lst: str) -> str:
    return f"list_filter({lst}, lambda x: contains(x, '@example.com'))"


_OWNERS = _mails(sql_set("tbl_owners"))
_READERS = _mails(
    f"list_filter({sql_set('downstream_users')}, lambda x: not list_contains({sql_set('tbl_owners')}, x) "
    "and x <> 'table_scanner@example.com')"
)


@query(
    "recipients",
    f"select task_id, {sql_text(_OWNERS)} owner_mails, {sql_text(_READERS)} reader_mails from jobs",
)
def _(spark, sf):
    return flat(outbox.recipients(jobs(spark, sf)).select("task_id", "owner_mails", "reader_mails"))


# All readers of a table, as a set per row and as pairs.
_ALL_READERS = """readers as (select source_name, case when contains(user_id, '@example.com') then user_id
 else user_id || '@example.com' end who from lineage where operation = 'read' group by all)"""


_BATCHES = f"""with {_ALL_READERS}, numbered as (select source_name, who,
 (row_number() over (partition by source_name order by substr(md5(who), 1, 3), who) - 1) // 50 as batch from readers)
select source_name, cast(batch as int) batch, string_agg(who, ',' order by who) recipients
from numbered group by source_name, batch"""


@query("recipient_batches", _BATCHES)
def _(spark, sf):
    pairs = enrich.readers(fixture(spark, sf, "lineage"))
    sets = enrich.fold_sets(pairs, ["source_name"], "downstream_user", "users")
    return flat(outbox.recipient_batches(sets, "users", ["source_name"]))


@query("recipient_batches_of_pairs", _BATCHES)
def _(spark, sf):
    pairs = enrich.readers(fixture(spark, sf, "lineage"))
    return flat(outbox.recipient_batches_of_pairs(pairs, ["source_name"], "downstream_user"))


_GATED = f"""empty_tables as ({EMPTY_TABLES}), run as (select * from jobs where migration_paused = 0 and
 ((to_be_processed = 1 and comm_level1_date is null)
 or (in_process = 1 and comm_level1_date is not null and state = 'OPEN' and desired_state = 'OPEN' and comm_level2_date is null)
 or (in_process = 0 and comm_level2_date is not null and state = 'SOURCE_ARCHIVED' and desired_state = 'SOURCE_ARCHIVED'
  and comm_level3_date is null))),
g0 as (select run.*, src, {_OWNERS} owner_mails, {_READERS} reader_mails,
 to_be_processed = 1 and comm_level1_date is null l1,
 stg_format = 'parquet' or task_id in (select task_id from empty_tables) copyable
 from run left join (select {_KEY_SQL}, {IS_SOURCE} src from catalog) c using ({_KEY_SQL})),
g1 as (select *, case when l1 and src is null then 'TABLE_NOT_FOUND' when l1 and not src then 'ALREADY_TARGET'
  when l1 and not copyable then 'TEXT_FORMAT' end why,
 case when l1 then case when src and copyable then 1 end
  when in_process = 1 and state = 'OPEN' and desired_state = 'OPEN' and comm_level2_date is null
   and epoch_ms(timestamp '{AS_OF}') - epoch_ms(comm_level1_date) >= initial_gap_days * 86400000 then 2
  when in_process = 0 and state = 'SOURCE_ARCHIVED' and desired_state = 'SOURCE_ARCHIVED' and comm_level3_date is null
   and epoch_ms(timestamp '{AS_OF}') - epoch_ms(comm_level2_date) >= probation_gap_days * 86400000 then 3 end due_level
 from g0),
gated as (select *, coalesce(case due_level when 1 then len(owner_mails) > 0 and initial_gap_days > 0
  when 2 then probation_gap_days > 0 when 3 then initial_gap_days > 0 or probation_gap_days > 0 end, false) send_mail from g1)"""


def _run(spark, sf):
    run_jobs = selectors.select_notify(jobs(spark, sf))
    return outbox.notify_gate(run_jobs, fixture(spark, sf, "catalog"), empty_tables(spark, sf), AS_OF)


def _stamp(n: int) -> str:
    column = f"comm_level{n}_date"
    return f"{sql_time(f'case when due_level = {n} then timestamp {chr(39)}{AS_OF}{chr(39)} else {column} end')} {column}"


@query(
    "notify_gate",
    f"""with {_GATED} select task_id, due_level, send_mail, case when why is not null then 1 else migration_paused end
 migration_paused, coalesce(why, pause_reason) pause_reason, {_stamp(1)}, {_stamp(2)}, {_stamp(3)} from gated""",
)
def _(spark, sf):
    return flat(
        _run(spark, sf).select(
            "task_id",
            "due_level",
            "send_mail",
            "migration_paused",
            "pause_reason",
            "comm_level1_date",
            "comm_level2_date",
            "comm_level3_date",
        )
    )


def _long_date(days: str) -> str:
    return f"strftime(date '{AS_OF[:10]}' + cast({days} as int), '%A, %B %-d, %Y')"


def _phrase(n: str) -> str:
    return f"case when {n} > 1 then {n} || ' days' when {n} = 1 then '1 day' else 'shortly' end"


def _html(text: str) -> str:
    out = text
    for old, new in (("*", "<li>"), (". ' || chr(10) || '", "</li>")):
        out = f"replace({out}, '{old}', '{new}')"
    out = f"replace(replace({out}, chr(10) || chr(10), '<br><br>'), chr(10), '<br>')"
    return f"'<html><body><p>' || {out} || '</p></body></html>'"


_N = v.DEFAULT


def _digest(per_mail: int) -> str:
    text = f"""'You own these tables:' || chr(10) || items || chr(10) || 'They will be moved to the new table format on ' || day
 || ', which is ' || {_phrase('gap')} || ' from now.' || chr(10) || chr(10) || 'You can narrow down who may read them afterwards. What is not supported yet is listed at {_N.docs_url}.'
 || chr(10) || 'Please write to {_N.support_channel} before that day to delay the move.'"""
    return f"""announced as (select task_id, initial_gap_days gap, unnest(owner_mails) as owner from gated where due_level = 1 and send_mail),
triggers as (select owner, min(task_id) task_id, min_by(gap, task_id) gap from announced group by owner),
owned as (select distinct unnest({sql_set('tbl_owners')}) as owner, catalog_name || '.' || db_name || '.' || tbl_name t from run),
numbered as (select o.owner, t, (row_number() over (partition by o.owner order by substr(md5(t), 1, 3), t) - 1) // {per_mail} + 1 part
 from owned o join triggers g on o.owner = g.owner),
pages as (select owner, part, list_sort(list(t)) tables, count(*) over (partition by owner) parts from numbered group by owner, part),
paged as (select p.owner, cast(part as int) part, cast(parts as int) parts, task_id, gap, tables, {_long_date('gap')} as "day",
 array_to_string(list_transform(tables, lambda t: '* ' || t || '. '), chr(10)) items from pages p join triggers g on p.owner = g.owner),
digest as (select owner, part, parts, task_id, {sql_text('tables')} as "tables",
 'Table migration: tables you own will change their format on ' || day
  || ' (part ' || part || ' of ' || parts || ')' subject, {_html(text)} body from paged)"""


# A small page, so that owners with many tables need several.
_PER_MAIL = 3


@query("owner_digest", f"with {_GATED}, {_digest(1000)} select * from digest")
def _(spark, sf):
    return flat(outbox.owner_digest(pin(_run(spark, sf), "run"), AS_OF))


@query("owner_digest_parts", f"with {_GATED}, {_digest(_PER_MAIL)} select * from digest")
def _(spark, sf):
    gated = pin(_run(spark, sf), "run")
    return flat(outbox.owner_digest(gated, AS_OF, tables_per_mail=_PER_MAIL))


_TABLE = "catalog_name || '.' || db_name || '.' || tbl_name"
_NL = "chr(10) || chr(10)"
_OUTBOX = f"""letters as (select due_level as "level", case when due_level = 1 then 'readers' else 'readers and owners' end audience,
 task_id, case when due_level = 1 then reader_mails else list_distinct(list_concat(reader_mails, owner_mails)) end who,
 case due_level
  when 1 then 'Table migration: ' || {_TABLE} || ' will change its format on ' || {_long_date('initial_gap_days')}
  when 2 then 'Table migration: ' || {_TABLE} || ' is on probation' || case when probation_gap_days > 0 then ' for ' || probation_gap_days || ' Days' else '' end
  else 'Table migration: ' || {_TABLE} || ' is complete' end subject,
 case due_level
  when 1 then 'Hello,' || {_NL} || 'you have read the table ' || {_TABLE} || ' before. It will be moved to the new table format on '
   || {_long_date('initial_gap_days')} || ' (' || {_phrase('initial_gap_days')} || ' from now).' || {_NL} || 'Afterwards the owners ('
   || array_to_string(owner_mails, ', ') || ') may narrow down who can read it; until then access stays as it is. '
   || 'Your queries need no change. More at {_N.docs_url}.' || {_NL}
   || 'To delay the move, please write to {_N.support_channel} before that day.'
  when 2 then 'The table ' || {_TABLE} || ' is now kept in the new table format.' || {_NL} || 'If it troubles you'
   || case when probation_gap_days > 0 then ' within the next ' || probation_gap_days || ' Days' else '' end
   || ', see {_N.docs_url} on how to go back, or write to {_N.support_channel}.'
  else 'You own or have read the table ' || {_TABLE} || '. Its move to the new table format is complete.' || {_NL}
   || 'There is nothing left to do.' end body
 from gated where send_mail),
addressed as (select task_id, unnest(who) as address from letters),
mail_groups as (select task_id, address, (row_number() over (partition by task_id order by substr(md5(address), 1, 3), address) - 1) // 50 as batch from addressed),
mail_batches as (select task_id, batch, string_agg(address, ',' order by address) recipients from mail_groups group by task_id, batch),
outbox as (select "level", audience, task_id, cast(batch as int) batch, recipients,
 subject, body, 'text' content_type from letters join mail_batches using (task_id)
 union all select 1, 'owner', task_id, part - 1, owner, subject, body, 'html' from digest)"""


@query("render_outbox", f"with {_GATED}, {_digest(1000)}, {_OUTBOX} select * from outbox")
def _(spark, sf):
    _, mails = notify_plan(jobs(spark, sf), fixture(spark, sf, "catalog"), empty_tables(spark, sf), AS_OF)
    return flat(mails)



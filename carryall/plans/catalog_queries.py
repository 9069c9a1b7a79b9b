"""Queries that change the table catalogue."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from carryall import vocabulary as v
from carryall.functions import sets
from carryall.operators import catalog as cat
from carryall.plans.fixtures import fixture, jobs
from carryall.plans.registry import IS_SOURCE, flat, query
from carryall.schemas import KEY

_KEY_SQL = ", ".join(KEY)
_TAGGED = [*KEY, "tags"]


def fleet(spark, sf):
    return fixture(spark, sf, "fleet")


def _tags_sql(lst: str) -> str:
    return f"array_to_string(list_sort({lst}), ',')"


# A changed catalogue keeps the untouched tag lists as they were.
_OLD_TAGS = "array_to_string(tags, ',')"
_CLEAN = "list_distinct(coalesce(tags, []))"


def _set_sql(a: str, b: str) -> str:
    return f"list_distinct(list_concat({a}, {b}))"


def _less_sql(a: str, b: str) -> str:
    return f"list_filter({a}, lambda x: not list_contains({b}, x))"


def _new_tags(spark, sf):
    tag = F.array(F.lit(" team_x "), F.when(F.col("task_id") % 2 == 0, "team_b"))
    none = F.array().cast("array<string>")
    listed = F.when(F.col("task_id") % 10 == 7, none).otherwise(tag)
    return jobs(spark, sf).select(*KEY, listed.alias("tags"))


_NEW = """(case when task_id % 10 = 7 then [] when task_id % 2 = 0 then ['team_b', 'team_x'] else ['team_x'] end)"""
_FLEET_JOBS = f"fleet left join (select task_id, {_KEY_SQL} from jobs) j using ({_KEY_SQL})"


@query(
    "add_tags",
    f"""select {_KEY_SQL}, case when task_id is null or len({_NEW}) = 0 then {_OLD_TAGS}
 else {_tags_sql(_set_sql(_CLEAN, _NEW))} end tags from {_FLEET_JOBS}""",
)
def _(spark, sf):
    return flat(cat.add_tags(fleet(spark, sf), _new_tags(spark, sf)).select(*_TAGGED))


@query(
    "add_tags_where_tagged",
    f"""select {_KEY_SQL}, case when task_id is null or len({_NEW}) = 0 or tags is null then {_OLD_TAGS}
 else {_tags_sql(_set_sql(_CLEAN, _NEW))} end tags from {_FLEET_JOBS}""",
)
def _(spark, sf):
    return flat(cat.add_tags(fleet(spark, sf), _new_tags(spark, sf), "add").select(*_TAGGED))


@query(
    "replace_tags",
    f"""select {_KEY_SQL}, case when task_id is null then {_OLD_TAGS} else {_tags_sql(_NEW)} end tags
 from {_FLEET_JOBS}""",
)
def _(spark, sf):
    return flat(cat.add_tags(fleet(spark, sf), _new_tags(spark, sf), "replace").select(*_TAGGED))


@query(
    "remove_tags",
    f"""select {_KEY_SQL}, case when task_id is null then {_OLD_TAGS}
 else array_to_string({_less_sql('tags', "['team_b', 'do_not_rename', 'absent']")}, ',') end tags from {_FLEET_JOBS}""",
)
def _(spark, sf):
    gone = sets.literal_set(["team_b", "do_not_rename", "absent"])
    changes = jobs(spark, sf).select(*KEY, gone.alias("tags"))
    return flat(cat.remove_tags(fleet(spark, sf), changes).select(*_TAGGED))


@query(
    "lock_tables",
    f"""select {_KEY_SQL}, case when task_id is null or tags is null then {_OLD_TAGS}
 else {_tags_sql(_set_sql(_CLEAN, "['migration_do_not_modify']"))} end tags from {_FLEET_JOBS}""",
)
def _(spark, sf):
    return flat(cat.lock_tables(fleet(spark, sf), jobs(spark, sf)).select(*_TAGGED))


_LOCK = "['migration_do_not_modify']"


@query(
    "unlock_tables",
    f"""select {_KEY_SQL}, secure or task_id is not null as secure, case
 when task_id is not null and tags is not null then {_tags_sql(_less_sql(_CLEAN, _LOCK))}
 when tbl_name like '%\\_source' escape '\\' and tags is not null
  then {_tags_sql(_set_sql(_less_sql(_CLEAN, _LOCK), "['archived_source']"))}
 else {_OLD_TAGS} end tags from (select {_KEY_SQL}, tags, case when secure or task_id is not null then true else secure end secure,
  task_id from {_FLEET_JOBS}) x""",
)
def _(spark, sf):
    out = cat.unlock_tables(fleet(spark, sf), jobs(spark, sf), production=True)
    secure = F.col("secure")
    return flat(out.select(*KEY, F.when(secure.isNotNull(), secure).alias("secure"), "tags"))


@query(
    "writable_tables",
    f"""select {_KEY_SQL} from fleet where tags is null or not list_contains(tags, 'migration_do_not_modify')""",
)
def _(spark, sf):
    return cat.writable_tables(fleet(spark, sf)).select(*KEY)


# Which relatives each job's table has: one join per suffix against the distinct names.
_RELATIVES = {
    "base": "",
    "kept": "_source",
    "copy": "_target",
    "stored": "_source_archived",
    "former": "_target_archived",
    "retired": "_target_revert",
}


def _family_sql() -> str:
    found = ", ".join(f"{name}.t is not null {name}" for name in _RELATIVES)
    joins = " ".join(
        f"left join names {name} on {name}.c = j.catalog_name and {name}.d = j.db_name and {name}.t = j.tbl_name || '{suffix}'"
        for name, suffix in _RELATIVES.items()
    )
    return f"""names as (select distinct catalog_name c, db_name d, tbl_name t from fleet),
family as (select j.catalog_name, j.db_name, j.tbl_name, {found} from jobs j {joins})"""


_FAMILY = _family_sql()


def _renamed_sql(renames: str, extra: str = "") -> str:
    """The catalogue with renames(catalog_name, db_name, tbl_name, new_name) applied by hand."""
    return f"""with {_FAMILY}, renames as ({renames}){extra}
select catalog_name, db_name, coalesce(new_name, tbl_name) tbl_name, data_uri, {_OLD_TAGS} tags
from fleet left join renames using ({_KEY_SQL})"""


_PROMOTE_FINE = "(base or kept) and not (base and kept and copy)"
_PROMOTE = f"""select {_KEY_SQL}, tbl_name || '_source' new_name from family where {_PROMOTE_FINE} and base and not kept
union all select catalog_name, db_name, tbl_name || '_target', tbl_name from family where {_PROMOTE_FINE} and copy"""


def _after(spark, sf, operation):
    edits, _ = operation(jobs(spark, sf), fleet(spark, sf))
    return flat(cat.apply_edits(fleet(spark, sf), edits).select(*KEY, "data_uri", "tags"))


@query("promote", _renamed_sql(_PROMOTE))
def _(spark, sf):
    return _after(spark, sf, cat.promote)


@query(
    "promote_rejects",
    f"""with {_FAMILY} select {_KEY_SQL}, case when base then 'name already taken' else 'table not found' end reason
 from family where not ({_PROMOTE_FINE})""",
)
def _(spark, sf):
    return cat.promote(jobs(spark, sf), fleet(spark, sf))[1]


@query(
    "rename_plan",
    f"""with {_FAMILY}, renames as ({_PROMOTE}) select {_KEY_SQL}, new_name,
 {_tags_sql(f"list_filter({_CLEAN}, lambda x: x in ('do_not_drop', 'do_not_rename'))")} held_tags
 from renames join fleet using ({_KEY_SQL})""",
)
def _(spark, sf):
    edits, _ = cat.promote(jobs(spark, sf), fleet(spark, sf))
    return flat(cat.rename_plan(edits, fleet(spark, sf)))


_RESTORE_FINE = "base and kept and not copy"


@query(
    "restore",
    _renamed_sql(
        f"""select {_KEY_SQL}, tbl_name || '_target' new_name from family where {_RESTORE_FINE}
union all select catalog_name, db_name, tbl_name || '_source', tbl_name from family where {_RESTORE_FINE}"""
    ),
)
def _(spark, sf):
    return _after(spark, sf, cat.restore)


@query(
    "restore_rejects",
    f"""with {_FAMILY} select {_KEY_SQL}, case when not base then 'table not found'
 when not kept then 'no source to restore' else 'name already taken' end reason from family where not ({_RESTORE_FINE})""",
)
def _(spark, sf):
    return cat.restore(jobs(spark, sf), fleet(spark, sf))[1]


def _aside_sql(old: str, new: str, condition: str, tags: str) -> str:
    return f"""with {_FAMILY}, renames as (select catalog_name, db_name, tbl_name || '{old}' tbl_name,
 tbl_name || '{new}' new_name from family where {condition})
select catalog_name, db_name, coalesce(new_name, tbl_name) tbl_name, data_uri,
 case when new_name is null then {_OLD_TAGS} else {tags} end tags from fleet left join renames using ({_KEY_SQL})"""


@query(
    "archive_source",
    _aside_sql(
        "_source",
        "_source_archived",
        "kept and not stored",
        _tags_sql(
            _set_sql(_less_sql(_CLEAN, _LOCK), "['archived_source', 'do_not_drop', 'do_not_rename']")
        ),
    ),
)
def _(spark, sf):
    return _after(spark, sf, cat.archive_source)


@query(
    "retire_target",
    _aside_sql("_target", "_target_revert", "copy and not retired", _tags_sql(_less_sql("tags", _LOCK))),
)
def _(spark, sf):
    return _after(spark, sf, cat.retire_target)


@query(
    "unarchive_source",
    _aside_sql(
        "_source_archived",
        "_source",
        "stored and not kept",
        _tags_sql(_less_sql("tags", "['do_not_drop', 'do_not_rename']")),
    ),
)
def _(spark, sf):
    return _after(spark, sf, cat.unarchive_source)


_BASES = f"bases as (select {_KEY_SQL}, {IS_SOURCE} src, list_distinct(coalesce(tags, [])) base_tags from fleet)"


@query(
    "swap_back_finalized",
    f"""with {_FAMILY}, {_BASES}, fine as (select * from family join bases using ({_KEY_SQL}) where stored and not src),
renames as (select {_KEY_SQL}, tbl_name || '_target_archived' new_name, 'target' part, null more from fine
 union all select catalog_name, db_name, tbl_name || '_source_archived', tbl_name, 'source', base_tags from fine
 union all select catalog_name, db_name, tbl_name || '_target_archived', null, 'gone', null from fine where former)
select catalog_name, db_name, coalesce(new_name, tbl_name) tbl_name, data_uri, case when part = 'source' and tags is null and len(more) = 0 then null
 when part = 'source' then {_tags_sql(_set_sql(_less_sql(_CLEAN, "['do_not_drop', 'do_not_rename']"), 'more'))}
 else {_OLD_TAGS} end tags
from fleet left join renames using ({_KEY_SQL}) where part is null or part <> 'gone'""",
)
def _(spark, sf):
    return _after(spark, sf, cat.swap_back_finalized)


@query(
    "drop_plan",
    f"""with {_FAMILY}, {_BASES}, gone as (select catalog_name, db_name, tbl_name || '_target_archived' tbl_name
 from family join bases using ({_KEY_SQL}) where stored and not src and former)
select {_KEY_SQL}, {_tags_sql(f"list_filter({_CLEAN}, lambda x: x in ('do_not_drop', 'do_not_rename'))")} held_tags
from gone join fleet using ({_KEY_SQL})""",
)
def _(spark, sf):
    edits, _ = cat.swap_back_finalized(jobs(spark, sf), fleet(spark, sf))
    return flat(cat.drop_plan(edits, fleet(spark, sf)))


@query(
    "swap_back_outcome",
    f"""with {_FAMILY}, {_BASES} select {_KEY_SQL}, coalesce(stored and not src, false) swapped,
 case when src is null then 'table not found' when src then 'already in source format'
 when not stored then 'migration not finalized' end reason from family left join bases using ({_KEY_SQL})""",
)
def _(spark, sf):
    return cat.swap_back_finalized(jobs(spark, sf), fleet(spark, sf))[1]


_DEFINED = """data_size, owner_user_id, secure, migrated_data_location, array_to_string(tags, ',') tags"""
_SOURCES = f"""kept as (select catalog_name c, db_name d, tbl_name t,
 data_size s_size, owner_user_id s_owner, secure s_secure, coalesce(migrated_data_location, data_uri) s_location,
 list_sort(list_distinct(list_concat(coalesce(tags, []), ['migrated_from_source']))) s_tags from fleet),
sources as (select j.catalog_name, j.db_name, j.tbl_name, s_size, s_owner, s_secure, s_location, s_tags
 from jobs j join kept on c = j.catalog_name and d = j.db_name and t = j.tbl_name || '_source')"""


@query(
    "copy_definition",
    f"""with {_SOURCES}, marked as (select fleet.*, s_size, s_owner, s_secure, s_location, s_tags, s_location is not null
  and not list_contains(coalesce(tags, []), 'migration_do_not_modify') hit from fleet left join sources using ({_KEY_SQL}))
select {_KEY_SQL}, case when hit then s_size else data_size end data_size,
 case when hit then s_owner else owner_user_id end owner_user_id, case when hit then s_secure else secure end secure,
 case when hit then s_location else migrated_data_location end migrated_data_location,
 array_to_string(case when hit then s_tags else tags end, ',') tags from marked""",
)
def _(spark, sf):
    out, _ = cat.copy_definition(jobs(spark, sf), fleet(spark, sf))
    return flat(
        out.select(*KEY, "data_size", "owner_user_id", "secure", "migrated_data_location", "tags")
    )


@query(
    "copy_definition_document",
    f"""with {_SOURCES}, kinds as (select catalog_name c, db_name d, tbl_name t, coalesce(lower(table_type), 'none') s_kind from fleet),
marked as (select fleet.*, s_owner, s_kind, s_location is not null
  and not list_contains(coalesce(tags, []), 'migration_do_not_modify') hit
 from fleet left join sources using ({_KEY_SQL}) left join kinds
  on c = fleet.catalog_name and d = fleet.db_name and t = fleet.tbl_name || '_source')
select {_KEY_SQL}, case when hit then 'kind=' || s_kind || ';legacy=yes;link=l/' || tbl_name || ';owner=' || s_owner
 when tbl_name like '%\\_source' escape '\\' then 'kind=' || coalesce(lower(table_type), 'none') || ';legacy=yes;link=l/' || tbl_name || ';owner=' || owner_user_id
 else 'fresh=1;kind=' || coalesce(lower(table_type), 'none') || ';link=l/' || tbl_name || ';owner=' || owner_user_id end definition from marked""",
)
def _(spark, sf):
    """The whole definition document goes along, unknown keys too; the link stays the target's."""
    kept = F.endswith("tbl_name", F.lit("_source"))
    pairs = [
        F.lit("owner"), F.col("owner_user_id"), F.lit("kind"), F.coalesce(F.lower("table_type"), F.lit("none")),
        F.lit("link"), F.concat(F.lit("l/"), F.col("tbl_name")),
        F.when(kept, "legacy").otherwise("fresh"), F.when(kept, "yes").otherwise("1"),
    ]
    documented = fleet(spark, sf).withColumn("definition", F.create_map(*pairs))
    out, _ = cat.copy_definition(jobs(spark, sf), documented, replace(v.DEFAULT, own_definition_keys=("link",)))
    entries = F.array_sort(F.transform(F.map_entries("definition"), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return out.select(*KEY, F.array_join(entries, ";").alias("definition"))


@query(
    "copy_definition_rejects",
    f"""with {_SOURCES} select {_KEY_SQL}, 'source has no location' reason from fleet join sources using ({_KEY_SQL})
 where s_location is null and not list_contains(coalesce(tags, []), 'migration_do_not_modify')""",
)
def _(spark, sf):
    return cat.copy_definition(jobs(spark, sf), fleet(spark, sf))[1]


# Data-catalogue records: the fleet's owner and size stand for their content.
_RECORDS = f"""records as (select {_KEY_SQL}, owner_user_id || '/' || tbl_name id, data_uri "location",
 'link/' || tbl_name source_link, owner_user_id audit, data_size, case when secure then 'pi' else 'open' end dlm_category
 from fleet)"""


def _records(spark, sf):
    return fleet(spark, sf).select(
        *KEY,
        F.concat("owner_user_id", F.lit("/"), "tbl_name").alias("id"),
        F.col("data_uri").alias("location"),
        F.concat(F.lit("link/"), "tbl_name").alias("source_link"),
        F.col("owner_user_id").alias("audit"),
        "data_size",
        F.create_map(F.lit("category"), F.when(F.col("secure"), "pi").otherwise("open")).alias("dlm"),
    )


@query(
    "copy_classification",
    f"""with {_RECORDS}, sides as (select catalog_name c, db_name d, tbl_name t, audit k_audit, data_size k_size,
  dlm_category k_dlm from records),
kept as (select j.catalog_name, j.db_name, j.tbl_name, true hit, k_audit, k_size, k_dlm
 from jobs j join sides on c = j.catalog_name and d = j.db_name and t = j.tbl_name || '_source')
select {_KEY_SQL}, id, "location", source_link, case when hit then k_audit else audit end audit,
 case when hit then k_size else data_size end data_size, case when hit then k_dlm else dlm_category end dlm_category
from records left join kept using ({_KEY_SQL})""",
)
def _(spark, sf):
    out = cat.copy_classification(jobs(spark, sf), _records(spark, sf))
    return out.select(
        *KEY, "id", "location", "source_link", "audit", "data_size", F.col("dlm")["category"].alias("dlm_category")
    )


@query(
    "set_secure_owner",
    f"""select {_KEY_SQL}, case when task_id is not null then true else secure end secure,
 case when task_id is not null then 'o' || task_id else owner_user_id end owner_user_id from {_FLEET_JOBS}""",
)
def _(spark, sf):
    keys = jobs(spark, sf)
    owners = keys.select(*KEY, F.concat(F.lit("o"), F.col("task_id")).alias("owner_user_id"))
    return cat.set_owner(cat.set_secure(fleet(spark, sf), keys), owners).select(
        *KEY, "secure", "owner_user_id"
    )

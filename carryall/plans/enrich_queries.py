"""Queries that join facts about tables to the queue."""

from __future__ import annotations

from pyspark.sql import functions as F

from carryall.functions.names import qualified
from carryall.operators import enrich
from carryall.plans.fixtures import DAY_KEY, base, fixture, jobs
from carryall.plans.registry import EMPTY_TABLES, IS_SOURCE, NAME, flat, query, sql_set, sql_text
from carryall.schemas import KEY

_KEY_SQL = ", ".join(KEY)


def catalog(spark, sf):
    """The catalogue fixture with its column list."""
    one = F.struct(F.col("col_name").alias("name"), F.col("col_type").alias("source_type"))
    two = F.struct(F.lit("c2").alias("name"), F.col("more_type").alias("source_type"))
    return fixture(spark, sf, "catalog").withColumn("fields", F.array(one, two))


def filled_tables(spark, sf):
    """Tables with at least one row: an order's table holds the order's line items."""
    lines = base(spark, sf, "lineitem").select(F.col("l_orderkey").alias("task_id")).distinct()
    return jobs(spark, sf).join(lines, "task_id", "left_semi").select(*KEY)


def empty_tables(spark, sf):
    found = enrich.find_empty_tables(
        jobs(spark, sf).select("task_id", *KEY), catalog(spark, sf), filled_tables(spark, sf)
    )
    return found.filter("is_empty")


def category_metadata(spark, sf):
    tags = F.create_map("tag_key", "tag_value")
    return fixture(spark, sf, "contacts").select("table_name", tags.alias("category_tags"))


def owner_sources(spark, sf):
    def contacts(name):
        listed = F.when(F.col("contact") == "", F.array().cast("array<string>")).otherwise(
            F.split("contact", ",")
        )
        return fixture(spark, sf, name).withColumn("contacts", listed)

    return contacts("contacts"), contacts("meta_daily"), fixture(spark, sf, "meta_events")


@query(
    "classify_storage",
    f"""select {_KEY_SQL}, case when lower(output_format) like '%parquet%' then 'parquet' else 'csv/text' end stg_format
 from catalog""",
)
def _(spark, sf):
    return enrich.classify_storage(fixture(spark, sf, "catalog")).select(*KEY, "stg_format")


@query(
    "classify_kind",
    f"""select task_id, src is not null as "exists", coalesce(src, false) is_source
 from jobs left join (select {_KEY_SQL}, {IS_SOURCE} src from catalog) c using ({_KEY_SQL})""",
)
def _(spark, sf):
    out = enrich.classify_kind(jobs(spark, sf), fixture(spark, sf, "catalog"))
    return out.select("task_id", "exists", "is_source")


HAS_TS = """len(list_filter([{'n': col_name, 't': lower(col_type)}, {'n': 'c2', 't': lower(more_type)}],
 lambda f: f.n <> 'timestamp' and f.t is not null and contains(f.t, 'timestamp') and not contains(f.t, 'timestamp:'))) > 0"""


@query("detect_rewrite_types", f"select {_KEY_SQL}, {HAS_TS} has_ts from catalog")
def _(spark, sf):
    return enrich.detect_rewrite_types(catalog(spark, sf)).select(*KEY, "has_ts")


@query(
    "find_empty_tables",
    f"""with empty_tables as ({EMPTY_TABLES})
 select task_id, task_id in (select task_id from empty_tables) is_empty from jobs""",
)
def _(spark, sf):
    found = enrich.find_empty_tables(jobs(spark, sf), catalog(spark, sf), filled_tables(spark, sf))
    return found.select("task_id", "is_empty")


@query(
    "unknown_size_tables",
    f"select {_KEY_SQL} from catalog where ({IS_SOURCE}) and (data_size is null or data_size = -1)",
)
def _(spark, sf):
    return enrich.unknown_size_tables(jobs(spark, sf), fixture(spark, sf, "catalog"))


OWNERS = f"""
select table_name, owners from (
 select *, row_number() over (partition by table_name order by pick, owners) n from (
  select table_name, 1 pick, list_sort(list_distinct(split(contact, ','))) owners from contacts where contact <> ''
  union all
  select table_name, 2, case when contact = '' then [] else [contact] end from meta_daily where dateint = {DAY_KEY}
  union all
  select table_name, 3, case when u is null then [] else [u || '@example.com'] end from (
   select table_name, json_extract_string(max_by(current_json, event_time), '$.definitionMetadata.owner.userId') u
   from meta_events where current_json <> '' group by table_name) e) a) b
where n = 1"""


@query(
    "resolve_owners",
    f"""with owners as ({OWNERS}) select task_id, coalesce({sql_text('owners')}, '') tbl_owners
 from jobs left join owners on table_name = {NAME}""",
)
def _(spark, sf):
    found = enrich.resolve_owners(jobs(spark, sf), *owner_sources(spark, sf), DAY_KEY)
    return flat(found.select("task_id", "tbl_owners"))


READERS = """
select distinct source_name, case when contains(user_id, '@example.com') then user_id else user_id || '@example.com' end
 downstream_user from lineage where operation = 'read' and user_id is not null"""


@query("readers", READERS)
def _(spark, sf):
    return enrich.readers(fixture(spark, sf, "lineage"))


@query(
    "downstream_users",
    f"""with readers as ({READERS}) select task_id, {_KEY_SQL}, downstream_user
 from jobs join readers on source_name = {NAME}""",
)
def _(spark, sf):
    return enrich.downstream_users(jobs(spark, sf), fixture(spark, sf, "lineage"))


@query(
    "reader_sets",
    f"""with readers as ({READERS}) select source_name, string_agg(downstream_user, ',' order by downstream_user)
 downstream_users from readers group by source_name""",
)
def _(spark, sf):
    pairs = enrich.readers(fixture(spark, sf, "lineage"))
    return flat(enrich.fold_sets(pairs, ["source_name"], "downstream_user", "downstream_users"))


CATEGORY = """case when tag_key = 'core_pi' then 'CORE_PI' when tag_key = 'pi' and tag_value = 'yes' then 'PI'
 when tag_key = 'pi' and tag_value = 'no' then 'NO_PI' else 'UNKNOWN' end"""


@query(
    "data_category",
    f"""select task_id, {CATEGORY} data_category from jobs left join contacts on table_name = {NAME}""",
)
def _(spark, sf):
    out = enrich.categorize(jobs(spark, sf), category_metadata(spark, sf))
    return out.select("task_id", "data_category")


@query(
    "owner_tables",
    f"""select distinct unnest({sql_set('tbl_owners')}) as owner,
 catalog_name || '.' || db_name || '.' || tbl_name as "table" from jobs""",
)
def _(spark, sf):
    return enrich.owner_tables(jobs(spark, sf))


def reader_columns(spark, sf):
    """Sets of readers keyed as the queue's enrichment wants them."""
    pairs = enrich.readers(fixture(spark, sf, "lineage")).withColumnRenamed("source_name", "table_name")
    return enrich.fold_sets(pairs, ["table_name"], "downstream_user", "downstream_users")


__all__ = [
    "CATEGORY",
    "HAS_TS",
    "OWNERS",
    "READERS",
    "catalog",
    "category_metadata",
    "empty_tables",
    "filled_tables",
    "owner_sources",
    "qualified",
    "reader_columns",
]

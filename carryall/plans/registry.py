"""Registered queries, each next to the SQL it is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from carryall.plans.fixtures import with_fixtures

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None) -> Callable[[Query], Query]:
    """Registers a query and, where one can be written, its checking SQL."""

    def register(fn: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        _QUERIES[name] = fn
        if check is not None:
            _CHECKS[name] = check
        return fn

    return register


def load() -> tuple[dict[str, Query], dict[str, str]]:
    # Importing the modules fills the registry.
    from carryall.plans import (  # noqa: F401
        catalog_queries,
        enrich_queries,
        incremental_queries,
        lifecycle_queries,
        movement_queries,
        outbox_queries,
        queue_queries,
        run_queries,
    )

    return dict(_QUERIES), {name: with_fixtures(sql) for name, sql in _CHECKS.items()}


def flat(df: DataFrame) -> DataFrame:
    """Arrays of text as comma lists and timestamps as text, for comparison."""

    def plain(field) -> Column:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.ArrayType):
            col = F.array_join(col, ",")
        elif isinstance(field.dataType, (T.TimestampNTZType, T.TimestampType)):
            col = F.date_format(col, "yyyy-MM-dd HH:mm:ss")
        return col.alias(field.name)

    return df.select(*[plain(f) for f in df.schema.fields])


# Pieces of checking SQL.


def sql_set(column: str) -> str:
    """A JSON array of text as a sorted distinct list; NULL as the empty list."""
    return f"coalesce(list_sort(list_distinct(from_json({column}, '[\"VARCHAR\"]'))), [])"


def sql_text(lst: str) -> str:
    return f"array_to_string({lst}, ',')"


def sql_time(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


NAME = "catalog_name || '/' || db_name || '/' || tbl_name"

# Is a catalogue entry in source format (see classify_kind)?
IS_SOURCE = (
    "case when table_type is not null then not contains(lower(table_type), 'iceberg') "
    "else coalesce(contains(serde_uri, 'hive'), false) end"
)

# Keys of empty source tables, where lineitem rows stand for rows of tables.
EMPTY_TABLES = f"""
select j.task_id, j.catalog_name, j.db_name, j.tbl_name
from jobs j join catalog c on j.catalog_name = c.catalog_name and j.db_name = c.db_name and j.tbl_name = c.tbl_name
where ({IS_SOURCE}) and (c.data_size = 0 or ((c.data_size is null or c.data_size = -1)
  and j.task_id not in (select l_orderkey from lineitem)))"""

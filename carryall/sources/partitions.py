"""Partitions of catalogue tables: scanned by name, pointed to folders, dropped.

A partition is replaced by writing its new rows to a folder of their own and pointing
its name there; whatever fails before leaves the old files in place. Names and folders
of the partitions concerned come to the driver, never rows.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from carryall.sources.tables import pin, spread, table_location

# Partitions named in the filter of one scan; there are as many scans as it takes.
KEYS_PER_SCAN = 10_000
PER_STATEMENT = 100


def sql_literal(value) -> str:
    """A value as a partition specification takes it; only nulls and whole numbers go unquoted."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "'true'" if value else "'false'"
    if isinstance(value, int):
        return str(value)
    if isinstance(value, float):
        text = "NaN" if math.isnan(value) else repr(value).replace("inf", "Infinity")
    elif isinstance(value, (bytes, bytearray)):
        text = bytes(value).decode("utf-8", "replace")
    else:
        text = str(value)
    text = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def specification(row, parts: list[str]) -> str:
    return "PARTITION (" + ", ".join(f"`{p}` = {sql_literal(row[p])}" for p in parts) + ")"


def file_manifest(df: DataFrame, parts: list[str]) -> DataFrame:
    """Files of a file-based table: (file_path, partition columns, record_count), from footers."""
    return (
        df.select(F.col("_metadata.file_path").alias("file_path"), *[F.col(f"`{p}`") for p in parts])
        .groupBy("file_path", *[F.col(f"`{p}`") for p in parts])
        .agg(F.count(F.lit(1)).alias("record_count"))
    )


def folders(manifest: DataFrame, parts: list[str]) -> DataFrame:
    """(partition columns, __folder) of a manifest."""
    folder = F.regexp_replace("file_path", "/[^/]+$", "")
    return manifest.select(*[F.col(f"`{p}`") for p in parts], folder.alias("__folder")).distinct()


def only_partitions(df: DataFrame, wanted: DataFrame, parts: list[str]) -> DataFrame:
    """Rows of the wanted partitions, nulls included; other partitions' files are not listed.

    The filter is a set of texts made of partition columns alone, so it prunes at
    any size. Names only come to the driver.
    """
    types = {f.name: f.dataType for f in wanted.schema.fields}

    def key(source) -> Column:
        # A text is led by a letter, so that no text stands for null.
        texts = [F.coalesce(F.concat(F.lit("v"), source(p).cast(types[p]).cast("string")), F.lit("n")) for p in parts]
        return F.concat_ws("\u0001", *texts)

    own = key(lambda p: F.col(f"`{p}`"))
    found, group = None, []

    def scan(keys: list[str]) -> DataFrame:
        return df.filter(own.isin(keys))

    for row in wanted.select(own.alias("key")).toLocalIterator():
        group.append(row["key"])
        if len(group) == KEYS_PER_SCAN:
            found = scan(group) if found is None else found.unionByName(scan(group))
            group = []
    if group or found is None:
        found = scan(group) if found is None else found.unionByName(scan(group))
    return found


def _in_statements(spark: SparkSession, rows: DataFrame, statement: str, piece, between: str) -> int:
    """One statement for every hundred rows; the number of rows."""
    held: list[str] = []
    n = 0
    for row in rows.toLocalIterator():
        held.append(piece(row))
        n += 1
        if len(held) == PER_STATEMENT:
            spark.sql(statement + between.join(held))
            held = []
    if held:
        spark.sql(statement + between.join(held))
    return n


def drop_partitions(spark: SparkSession, table: str, gone: DataFrame, parts: list[str]) -> int:
    """Drops partitions by name; of an external table the files stay."""
    return _in_statements(spark, gone, f"ALTER TABLE {table} DROP IF EXISTS ", lambda r: specification(r, parts), ", ")


def add_partitions(spark: SparkSession, table: str, placed: DataFrame, parts: list[str]) -> int:
    """Adds partitions that lie in the folders of placed(parts…, __folder)."""

    def piece(row) -> str:
        return f"{specification(row, parts)} LOCATION {sql_literal(unquote(row['__folder']))}"

    return _in_statements(spark, placed, f"ALTER TABLE {table} ADD ", piece, " ")


def point_partitions(spark: SparkSession, table: str, placed: DataFrame, parts: list[str]) -> int:
    """Points partitions to the folders of placed(parts…, __folder, is_new).

    A partition that has rows already changes from its old files to the new ones in one
    statement. New ones are added together, over whatever empty entry they have.
    """
    fresh = placed.filter("is_new")
    drop_partitions(spark, table, fresh, parts)
    n = add_partitions(spark, table, fresh, parts)
    for row in placed.filter("not is_new").toLocalIterator():
        spark.sql(
            f"ALTER TABLE {table} {specification(row, parts)} SET LOCATION {sql_literal(unquote(row['__folder']))}"
        )
        n += 1
    spark.catalog.refreshTable(table)
    return n


def revision_folder(spark: SparkSession, table: str) -> str:
    """An unused folder among the table's own files, which discovery of partitions passes over."""
    return f"{table_location(spark, table).rstrip('/')}/.rev-{uuid.uuid4().hex[:12]}"


def replace_partitions(
    spark: SparkSession,
    table: str,
    rows: DataFrame,
    parts: list[str],
    expected: DataFrame,
    shuffle: bool,
    recount: Callable[[], DataFrame] | None = None,
) -> int:
    """Replaces the partitions of expected(parts…, n_src, is_new) by ``rows``; their number.

    The rows are written once, to a folder of the table's own. Only when the footers
    there hold the expected number of rows for every partition are the names pointed to
    it. ``recount`` gives the source's rows as they are now: where others write to it
    meanwhile, a number between that of before and that of after is right as well.
    """
    folder = revision_folder(spark, table)
    laid_out = spread(rows, parts) if shuffle else rows
    laid_out.write.partitionBy(*parts).parquet(folder)
    schema = spark.table(table).schema
    written = pin(file_manifest(spark.read.schema(schema).option("basePath", folder).parquet(folder), parts), "written")
    counts = written.groupBy(*[F.col(f"`{p}`") for p in parts]).agg(F.sum("record_count").alias("__n"))
    match = [F.col(f"w.`{p}`").eqNullSafe(F.col(f"e.`{p}`")) for p in parts]
    both = expected.alias("e").join(counts.alias("w"), match, "full_outer")
    named = [F.coalesce(F.col(f"e.`{p}`"), F.col(f"w.`{p}`")).alias(p) for p in parts]
    wrong = pin(both.filter(~F.col("n_src").eqNullSafe(F.col("__n"))).select(*named, "n_src", "__n"), "unequal")
    if not wrong.isEmpty() and recount is not None:
        now = recount().groupBy(*[F.col(f"`{p}`") for p in parts]).agg(F.count(F.lit(1)).alias("__now"))
        match = [F.col(f"u.`{p}`").eqNullSafe(F.col(f"r.`{p}`")) for p in parts]
        zero = F.lit(0)
        before, after, n = (F.coalesce(F.col(c), zero) for c in ("n_src", "__now", "__n"))
        between = n.between(F.least(before, after), F.greatest(before, after))
        wrong = wrong.alias("u").join(now.alias("r"), match, "left").filter(~between)
    if not wrong.isEmpty():
        raise ValueError(f"{table}: the source's partitions do not have the rows that were copied")
    match = [F.col(f"f.`{p}`").eqNullSafe(F.col(f"e.`{p}`")) for p in parts]
    placed = folders(written, parts).alias("f").join(expected.alias("e"), match).select(
        *[F.col(f"f.`{p}`").alias(p) for p in parts], "__folder", "is_new"
    )
    return point_partitions(spark, table, pin(placed, "placed"), parts)


def foreign_files(spark: SparkSession, table: str, rows: DataFrame, parts: list[str]) -> DataFrame:
    """Manifest of the files in ``rows`` of a table that lie outside the table's own folder."""
    own = _plain(F.lit(table_location(spark, table).rstrip("/") + "/"))
    return file_manifest(rows, parts).filter(~F.startswith(_plain(F.col("file_path")), own))


def _plain(path: Column) -> Column:
    """Paths with one way of writing the slashes after the scheme."""
    return F.regexp_replace(path, "^([a-z0-9+.-]+):/+", "$1:/")

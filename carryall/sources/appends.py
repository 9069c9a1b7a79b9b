"""Rows appended to user tables, and the ledger of what was really written."""

from __future__ import annotations

import contextlib
import threading

from pyspark.sql import DataFrame, SparkSession, functions as F

from carryall.sources.partitions import foreign_files, only_partitions, replace_partitions
from carryall.sources.tables import (
    SHARED_FILES,
    commit_rows,
    fresh_name,
    fresh_path,
    get_property,
    partition_columns,
    pin,
    spread,
)

# How the files of a write begin; "part" where it is not set.
_FILE_NAMES = "mapreduce.output.basename"
_ONE_AT_A_TIME = threading.Lock()


def append_rows(
    df: DataFrame, table: str, snapshot_id: int, committed_at, operation: str = "append"
) -> DataFrame:
    """Appends by position to a table and gives the ledger rows of the commit.

    The rows' columns are taken in the table's order whatever their names are. The files
    of an append share a name of their own, and the ledger counts the rows in the footers
    of just these files: it tells what was written, not what the input gives when it is
    read once more. Of a table that shares files, only the partitions appended to get
    files of their own.
    """
    spark = df.sparkSession
    target = spark.table(table)
    if len(df.columns) != len(target.columns):
        raise ValueError(f"{table} has {len(target.columns)} columns, not {len(df.columns)}")
    rows = df.toDF(*target.columns)
    parts = partition_columns(spark, table)
    if get_property(spark, table, SHARED_FILES) is not None:
        # The partitions made the table's own have to be those that are written to.
        rows = pin(rows, "appended")
        own_partitions(spark, table, rows, parts)
    name = fresh_name("append")
    with _files_named(spark, name):
        spread(rows, parts).write.insertInto(table)
    spark.catalog.refreshTable(table)
    written = spark.table(table).filter(F.startswith(F.col("_metadata.file_name"), F.lit(name + "-")))
    return pin(commit_rows(written, table, parts, snapshot_id, committed_at, operation), "commit")


@contextlib.contextmanager
def _files_named(spark: SparkSession, name: str):
    """Files written by this session meanwhile begin with a name of their own."""
    with _ONE_AT_A_TIME:
        spark.conf.set(_FILE_NAMES, name)
        try:
            yield
        finally:
            spark.conf.unset(_FILE_NAMES)


def own_partitions(spark: SparkSession, table: str, rows: DataFrame, parts: list[str]) -> int:
    """Gives a table files of its own for the partitions that ``rows`` go to; their number.

    Partitions that have their own already are passed over. A table without partitions is
    copied whole.
    """
    if not parts:
        own_whole(spark, table, spark.table(table))
        return 1
    touched = pin(rows.select(*[F.col(f"`{p}`") for p in parts]).distinct(), "touched")
    here = only_partitions(spark.table(table), touched, parts)
    shared = foreign_files(spark, table, here, parts)
    counts = shared.groupBy(*[F.col(f"`{p}`") for p in parts]).agg(F.sum("record_count").alias("n_src"))
    expected = pin(counts.withColumn("is_new", F.lit(False)), "shared")
    if expected.isEmpty():
        return 0
    taken = only_partitions(spark.table(table), expected, parts)
    n = replace_partitions(spark, table, taken, parts, expected, shuffle=False)
    settle(spark, table, parts)
    return n


def own_whole(spark: SparkSession, table: str, rows: DataFrame) -> None:
    """Puts ``rows`` in the place of a table's files: written once, then the name is pointed there."""
    folder = fresh_path(spark, "own")
    rows.select(*spark.table(table).columns).write.parquet(folder)
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
    spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES IF EXISTS ('{SHARED_FILES}')")
    spark.catalog.refreshTable(table)


def settle(spark: SparkSession, table: str, parts: list[str]) -> bool:
    """Takes the mark of shared files off a table that has none any more."""
    if get_property(spark, table, SHARED_FILES) is None:
        return True
    if not foreign_files(spark, table, spark.table(table), parts).limit(1).isEmpty():
        return False
    spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES IF EXISTS ('{SHARED_FILES}')")
    return True

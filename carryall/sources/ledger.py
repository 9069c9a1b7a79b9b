"""A summary of the ledger that is kept up to date from new ledger files alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from carryall.operators.movement import partition_commits, table_commits
from carryall.sources.store import StoredTable
from carryall.sources.tables import fresh_path

_PARTITIONS = "table_name string, partition_values map<string,string>, committed_at timestamp_ntz, snapshot_id bigint"
_COMMITS = "table_name string, snapshot_id bigint, committed_at timestamp_ntz"


class LedgerSummary:
    """Last commits per (table, partition) of a ledger that is a folder of Parquet files.

    The high-water mark is the set of files folded in so far, not a time: commits may be
    older than those already there. ``fold`` reads the new files only. It writes the
    summary first and the mark last; if it is cut off between, the files are folded once
    more, which changes nothing, as a maximum of commits does not count them. A ledger
    file must not change once it is written; a file that comes from putting others
    together is folded like any other.

    ``partitions`` stands for the ledger in ``latest_snapshot`` and
    ``touched_partitions``, with ``commits`` to look watermarks up in. Both are as of the
    last ``fold``. An empty ledger gives empty tables; rows without a table name are kept
    under null.
    """

    def __init__(self, spark: SparkSession, ledger_path: str) -> None:
        self.spark, self.ledger_path = spark, ledger_path
        self._last = StoredTable(spark, spark.createDataFrame([], _PARTITIONS), "ledger_summary")
        self._commits_path, self._files_path = fresh_path(spark, "commits"), fresh_path(spark, "folded")
        spark.createDataFrame([], _COMMITS).write.parquet(self._commits_path)
        spark.createDataFrame([], "file string").write.parquet(self._files_path)

    def new_files(self) -> DataFrame:
        """Ledger files not folded in yet: (file). Lists the folder, opens no file."""
        listed = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(self.ledger_path)
        folded = self.spark.read.schema("file string").parquet(self._files_path)
        return listed.select(F.col("path").alias("file")).join(folded, "file", "left_anti")

    def fold(self, schema: str | None = None) -> int:
        """Takes new ledger files in; their number. ``schema`` is that of the ledger rows."""
        files = [r["file"] for r in self.new_files().toLocalIterator()]
        if not files:
            return 0
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        tail = reader.parquet(*files)
        rows = tail.select(
            "table_name",
            "partition_values",
            F.col("committed_at").cast("timestamp_ntz").alias("committed_at"),
            F.col("snapshot_id").cast("bigint").alias("snapshot_id"),
        )
        # A commit that is in several files has a row of each; readers take the last.
        table_commits(rows).select("table_name", "snapshot_id", "committed_at").write.mode("append").parquet(self._commits_path)
        self._last.replace(partition_commits(self._last.read().unionByName(partition_commits(rows))))
        self.spark.createDataFrame([(f,) for f in files], "file string").write.mode("append").parquet(self._files_path)
        return len(files)

    def partitions(self) -> DataFrame:
        """Last commit of every partition: (table_name, partition_values, committed_at, snapshot_id)."""
        return self._last.read()

    def commits(self) -> DataFrame:
        """All commits, for watermarks: (table_name, snapshot_id, committed_at)."""
        return self.spark.read.schema(_COMMITS).parquet(self._commits_path)

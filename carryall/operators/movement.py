"""Copying user tables, finding what changed since, and mirroring just that."""

from __future__ import annotations

import contextlib

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from carryall.functions.fingerprint import PIECE_NAMES, hash_pieces, hashable, row_hash
from carryall.functions.times import moment
from carryall.sources.appends import own_whole, settle
from carryall.sources.partitions import (
    add_partitions,
    drop_partitions,
    file_manifest,
    folders,
    only_partitions,
    replace_partitions,
)
from carryall.sources.tables import (
    SHARED_FILES,
    copy_rows,
    fresh_path,
    get_property,
    is_managed,
    is_parquet,
    partition_columns,
    pin,
    property_list,
    spread,
    table_location,
)

# Table properties set by the copy operators.
COPY_PROPERTIES = {"migrated-from-source": "true"}
WATERMARK = "watermark_snapshot_id"


# ---------------------------------------------------------------- copies


def snapshot_manifest(df: DataFrame, parts: list[str]) -> DataFrame:
    """Files of a file-based table: (file_path, partition columns, record_count).

    Reads the partition columns and file footers only.
    """
    return file_manifest(df, parts)


def snapshot_table(spark: SparkSession, src: str, dst: str) -> DataFrame:
    """Registers ``dst`` over the files of the Parquet table ``src``; copies nothing.

    Every partition of the source that has files is added where its files are,
    inside the table's folder or not; folders of partitions the source no longer
    has are not. A partitioned target has a folder of its own for the partitions that
    are written to later; the others stay shared, and the target is marked as long as
    there are any. Gives the manifest.
    """
    parts = partition_columns(spark, src)
    location = fresh_path(spark, "own") if parts else table_location(spark, src)
    spark.sql(f"DROP TABLE IF EXISTS {dst}")
    by = f" PARTITIONED BY ({', '.join(f'`{p}`' for p in parts)})" if parts else ""
    spark.sql(
        f"CREATE TABLE {dst} ({spark.table(src).schema.toDDL()}) USING parquet{by} "
        f"LOCATION '{location}' TBLPROPERTIES ({property_list({SHARED_FILES: src})})"
    )
    if parts:
        add_partitions(spark, dst, folders(snapshot_manifest(spark.table(src), parts), parts), parts)
        spark.catalog.refreshTable(dst)
    return snapshot_manifest(spark.table(dst), parts)


def rewrite_copy(
    spark: SparkSession,
    src: str,
    dst: str,
    provider: str = "parquet",
    location: str | None = None,
) -> DataFrame:
    """Creates ``dst`` with the schema and partitioning of ``src`` and copies all rows.

    An existing target is replaced once the copy is complete. External targets need a
    new folder.
    """
    copy_rows(spark, src, dst, provider, location, COPY_PROPERTIES)
    return spark.table(dst)


def copy_table(
    spark: SparkSession, src: str, dst: str, strategy: str, location: str | None = None
) -> str:
    """Runs the chosen strategy and gives the one used in the end.

    Tables in other formats are rewritten, and so are managed ones, whose files
    move when they are renamed. A snapshot of files that turn out not to be
    Parquet after all is undone and the table rewritten instead.
    """
    if strategy == "SNAPSHOT" and is_parquet(spark, src) and not is_managed(spark, src):
        try:
            # Footers of all files are read here, so foreign files show up now.
            total = F.coalesce(F.sum("record_count"), F.lit(0))
            copied = snapshot_table(spark, src, dst).agg(total).first()[0]
            rows = snapshot_manifest(spark.table(src), partition_columns(spark, src)).agg(total).first()[0]
            if copied == rows:
                return "SNAPSHOT"
        except (PySparkException, Py4JJavaError) as problem:
            if not _is_foreign_file(problem):
                raise
    rewrite_copy(spark, src, dst, location=location)
    return "REWRITE"


def _is_foreign_file(problem: Exception) -> bool:
    """Did Spark find a file that is not Parquet?"""
    condition = problem.getCondition() if isinstance(problem, PySparkException) else None
    if condition is not None:
        return condition.startswith(("FAILED_READ_FILE", "CANNOT_READ_FILE"))
    return "not a Parquet file" in str(problem)


# ---------------------------------------------------------------- ledger


def _last_commits(rows: DataFrame, keys: list[str], at: str) -> DataFrame:
    """The greatest (at, snapshot_id) of every key: (keys…, at, snapshot_id).

    Repeated commits are folded first, so that all buffers have a fixed width and
    both aggregations hash instead of sorting the ledger.
    """
    newest = F.max(at)
    last = F.when(newest.isNull(), F.max("snapshot_id")).otherwise(F.max_by("snapshot_id", at))
    commits = rows.groupBy(*keys, at).agg(F.max("snapshot_id").alias("snapshot_id"))
    return commits.groupBy(*keys).agg(newest.alias(at), last.alias("snapshot_id"))


def latest_snapshot(ledger: DataFrame) -> DataFrame:
    """Newest snapshot of every table: (table_name, snapshot_id)."""
    return _last_commits(ledger, ["table_name"], "committed_at").drop("committed_at")


def watermarks(mirror_log: DataFrame) -> DataFrame:
    """Last mirrored snapshot of every table: (table_name, watermark)."""
    last = _last_commits(mirror_log, ["table_name"], "mirrored_at")
    return last.select("table_name", F.col("snapshot_id").alias("watermark"))


def set_watermarks(tables: DataFrame, ledger: DataFrame, as_of) -> DataFrame:
    """Mirror-log rows that declare tables in sync as they are, as after a promote."""
    named = tables.select("table_name").distinct()
    return latest_snapshot(ledger.join(named, "table_name", "left_semi")).select(
        "table_name", "snapshot_id", moment(as_of).alias("mirrored_at")
    )


def watermark_properties(spark: SparkSession, tables: list[str]) -> DataFrame:
    """Watermarks kept as table properties, to be taken over: (table_name, watermark)."""
    rows = []
    for table in tables:
        value = get_property(spark, table, WATERMARK)
        rows.append((table, None if value is None else int(value)))
    return spark.createDataFrame(rows, "table_name string, watermark bigint")


def in_sync(tables: DataFrame, ledger: DataFrame, marks: DataFrame) -> DataFrame:
    """Adds snapshot_id, watermark and in_sync to tables(table_name, …).

    Both ids are compared as BIGINT; a table never mirrored counts as -1.
    """
    newest = latest_snapshot(ledger).withColumn("snapshot_id", F.col("snapshot_id").cast("bigint"))
    mark = F.coalesce(F.col("watermark"), F.lit(-1))
    return (
        tables.join(newest, "table_name", "left")
        .join(
            marks.select("table_name", F.col("watermark").cast("bigint").alias("watermark")),
            "table_name",
            "left",
        )
        .withColumn("in_sync", F.col("snapshot_id").eqNullSafe(mark))
    )


def partition_commits(ledger: DataFrame) -> DataFrame:
    """Last commit of every partition: (table_name, partition_values, committed_at, snapshot_id)."""
    by_partition = ledger.withColumn("__p", F.array_sort(F.map_entries("partition_values")))
    return _last_commits(by_partition, ["table_name", "__p"], "committed_at").select(
        "table_name", F.map_from_entries("__p").alias("partition_values"), "committed_at", "snapshot_id"
    )


def table_commits(ledger: DataFrame) -> DataFrame:
    """When each snapshot was committed, at the latest: (table_name, snapshot_id, committed_at)."""
    return ledger.groupBy("table_name", "snapshot_id").agg(F.max("committed_at").alias("committed_at"))


def touched_partitions(
    ledger: DataFrame, marks: DataFrame, commits: DataFrame | None = None
) -> DataFrame:
    """Partitions committed to after each table's watermark: (table_name, partition_values).

    "After" is the order of commits, not of ids. A table whose watermark is
    unknown to the ledger has all its partitions listed. Every partition is
    reduced to its last commit before the join. Watermarks are looked up in ``commits``
    where it is given (as kept by a ``LedgerSummary``), else in the ledger.
    """
    by_partition = ledger.withColumn("__p", F.array_sort(F.map_entries("partition_values")))
    last = _last_commits(by_partition, ["table_name", "__p"], "committed_at").select(
        "table_name", "__p", F.struct("committed_at", "snapshot_id").alias("__last")
    )
    return (
        last.join(mark_commits(ledger if commits is None else commits, marks), "table_name", "left")
        .filter(F.col("__mark").isNull() | (F.col("__last") > F.col("__mark")))
        .select("table_name", F.map_from_entries("__p").alias("partition_values"))
    )


def mark_commits(ledger: DataFrame, marks: DataFrame) -> DataFrame:
    """Commit position of each watermark: (table_name, __mark)."""
    known = ledger.select(
        "table_name", F.col("snapshot_id").cast("bigint").alias("watermark"), "committed_at"
    )
    wanted = marks.select("table_name", F.col("watermark").cast("bigint").alias("watermark"))
    marked = known.join(wanted, ["table_name", "watermark"], "left_semi").withColumnRenamed("watermark", "snapshot_id")
    return _last_commits(marked, ["table_name"], "committed_at").select(
        "table_name", F.struct("committed_at", "snapshot_id").alias("__mark")
    )


# ---------------------------------------------------------------- parity


def partition_stats(df: DataFrame, parts: list[str]) -> DataFrame:
    """Rows per partition."""
    return df.groupBy(*parts).agg(F.count(F.lit(1)).alias("record_count"))


def stats_total(stats: DataFrame) -> DataFrame:
    """One row: number of partitions and rows; an empty table has 0 of both."""
    return stats.agg(
        F.count(F.lit(1)).alias("partitions"),
        F.coalesce(F.sum("record_count"), F.lit(0)).cast("bigint").alias("record_count"),
    )


def _sides(src: DataFrame, dst: DataFrame, *columns: Column) -> DataFrame:
    """Both inputs in one, told apart by __src; aggregations then need no join."""
    left = src.select(*columns, F.lit(True).alias("__src"))
    return left.unionAll(dst.select(*columns, F.lit(False).alias("__src")))


def row_parity(src: DataFrame, dst: DataFrame) -> DataFrame:
    """(n_src, n_dst, equal) for two tables."""
    n_src = F.count_if(F.col("__src"))
    n_dst = F.count_if(~F.col("__src"))
    return _sides(src, dst).agg(
        n_src.alias("n_src"), n_dst.alias("n_dst"), (n_src == n_dst).alias("equal")
    )


def table_parity(src_stats: DataFrame, dst_stats: DataFrame) -> DataFrame:
    """The same for many tables, from (table_name, record_count) rows of any grain."""
    both = _sides(src_stats, dst_stats, F.col("table_name"), F.col("record_count"))
    n_src = F.coalesce(F.sum(F.when(F.col("__src"), F.col("record_count"))), F.lit(0))
    n_dst = F.coalesce(F.sum(F.when(~F.col("__src"), F.col("record_count"))), F.lit(0))
    return both.groupBy("table_name").agg(
        n_src.cast("bigint").alias("n_src"),
        n_dst.cast("bigint").alias("n_dst"),
        (n_src == n_dst).alias("equal"),
    )


def content_difference(src: DataFrame, dst: DataFrame) -> DataFrame:
    """Rows whose number of copies differs, with n_src and n_dst (exact, no hashing).

    Equal rows are counted map-side on both sides before they are shuffled, so
    many copies of one row never meet in a task.
    """
    types = {f.name: f.dataType for f in src.schema.fields}
    columns = [hashable(F.col(f"`{c}`"), types[c]).alias(c) for c in src.columns]
    both = _sides(src, dst, *columns)
    return (
        both.groupBy(*[F.col(f"`{c}`") for c in src.columns])
        .agg(F.count_if(F.col("__src")).alias("n_src"), F.count_if(~F.col("__src")).alias("n_dst"))
        .filter("n_src <> n_dst")
    )


# ---------------------------------------------------------------- changes


def fingerprints(src: DataFrame, dst: DataFrame, parts: list[str]) -> DataFrame:
    """Row counts and hash sums of both sides per partition.

    Both tables go through one aggregation with map-side combining; a partition,
    however large, reaches the shuffle as one small row per task.
    """
    names = list(src.columns)
    hashed = row_hash(src, names)
    other = row_hash(dst.select(*names), names)
    part_cols = [F.col(f"`{p}`") for p in parts]
    left = src.select(*part_cols, hashed.alias("__hash"), F.lit(True).alias("__src"))
    right = dst.select(*part_cols, other.alias("__hash"), F.lit(False).alias("__src"))
    both = left.unionAll(right)
    sums = []
    for i, piece in enumerate(hash_pieces(F.col("__hash"))):
        signed = F.when(F.col("__src"), piece).otherwise(-piece)
        sums.append(F.sum(signed).alias(PIECE_NAMES[i]))
    return both.groupBy(*parts).agg(
        F.count_if(F.col("__src")).alias("n_src"),
        F.count_if(~F.col("__src")).alias("n_dst"),
        *sums,
    )


def changed_partitions(src: DataFrame, dst: DataFrame, parts: list[str]) -> DataFrame:
    """Partitions that differ: (parts…, kind, n_src, n_dst), kind added/changed/removed.

    Compares fingerprints; ``content_difference`` is the proof where one is needed.
    """
    differs = F.col("n_src") != F.col("n_dst")
    for name in PIECE_NAMES:
        differs = differs | (F.col(name) != 0)
    return (
        fingerprints(src, dst, parts)
        .filter(differs)
        .select(*[F.col(f"`{p}`") for p in parts], _kind().alias("kind"), "n_src", "n_dst")
    )


def changed_ranges(
    src: DataFrame, dst: DataFrame, parts: list[str], key: str, width: int
) -> DataFrame:
    """Ranges of a whole-number key that differ: (parts…, key_from, key_to, n_src, n_dst).

    The second level below ``changed_partitions``: a partition's rows are fingerprinted by
    ranges of ``width`` key values, ``key_from`` to ``key_to``, the last one included. Rows
    without a key have a range of their own, with both ends null. A partition with a
    third of all rows is many ranges, and each reaches the shuffle as a row per task.
    """
    numbered = [side.withColumn("__from", _range_start(F.col(f"`{key}`"), width)) for side in (src, dst)]
    return changed_partitions(*numbered, [*parts, "__from"]).select(
        *[F.col(f"`{p}`") for p in parts],
        F.col("__from").alias("key_from"),
        (F.col("__from") + (width - 1)).alias("key_to"),
        "n_src",
        "n_dst",
    )


def _range_start(key: Column, width: int) -> Column:
    return key.cast("bigint") - F.pmod(key.cast("bigint"), F.lit(width))


def range_difference(
    src: DataFrame, dst: DataFrame, parts: list[str], key: str, ranges: DataFrame
) -> DataFrame:
    """``content_difference`` of the rows in the given ranges alone.

    The proof of ``changed_ranges``. The partitions' names and at most _BOUNDS pairs of
    bounds of the key reach both scans as filters, so that row groups outside are not
    read where files are laid out by the key; a join then keeps just the ranges.
    """
    listed = pin(ranges.select(*[F.col(f"`{p}`") for p in parts], "key_from", "key_to"), "ranges")
    if listed.isEmpty():
        none = F.lit(False)
        return content_difference(src.filter(none), dst.filter(none))
    bounds = _key_bounds(listed, key)
    # All ranges have one width, so that the range of a row is known from its key.
    width = listed.agg(F.max(F.col("key_to") - F.col("key_from") + 1)).first()[0] or 1
    wanted = listed.select(*[F.col(f"`{p}`").alias(f"__{i}") for i, p in enumerate(parts)], "key_from")
    own = _range_start(F.col(f"`{key}`"), width).eqNullSafe(F.col("key_from"))
    for i, p in enumerate(parts):
        own = own & F.col(f"`{p}`").eqNullSafe(F.col(f"__{i}"))
    named = listed.select(*[F.col(f"`{p}`") for p in parts]).distinct()
    near = [only_partitions(side, named, parts) if parts else side for side in (src, dst)]
    return content_difference(*[side.filter(bounds).join(wanted, own, "left_semi") for side in near])


# Pairs of bounds that a scan's filter names at most; near ranges share a pair.
_BOUNDS = 64


def _key_bounds(ranges: DataFrame, key: str) -> Column:
    """A filter that holds for all keys in the ranges, and few others."""
    ends = ranges.agg(F.min("key_from").alias("low"), F.max("key_to").alias("high"), F.count_if(F.col("key_from").isNull()).alias("n_null")).first()
    value = F.col(f"`{key}`")
    found = value.isNull() if ends["n_null"] else F.lit(False)
    if ends["low"] is None:
        return found
    step = max(1, -(-(ends["high"] - ends["low"] + 1) // _BOUNDS))
    cell = _range_start(F.col("key_from") - F.lit(ends["low"]), step)
    cells = ranges.filter(F.col("key_from").isNotNull()).groupBy(cell.alias("cell")).agg(F.min("key_from").alias("low"), F.max("key_to").alias("high"))
    for row in cells.collect():
        found = found | value.between(F.lit(row["low"]), F.lit(row["high"]))
    return found


def _ledger_changes(
    src: DataFrame, dst: DataFrame, parts: list[str], touched: DataFrame
) -> DataFrame:
    """Touched partitions with their kind; only their files' footers are read."""
    types = {f.name: f.dataType for f in dst.schema.fields}
    values = F.col("partition_values")
    listed = pin(
        touched.select(*[values[p].cast(types[p]).alias(p) for p in parts]).distinct(), "touched"
    )
    part_cols = [F.col(f"`{p}`") for p in parts]
    both = _sides(
        only_partitions(src, listed, parts),
        only_partitions(dst, listed, parts),
        *part_cols,
    )
    return (
        both.groupBy(*parts)
        .agg(
            F.count_if(F.col("__src")).alias("n_src"), F.count_if(~F.col("__src")).alias("n_dst")
        )
        .select(*part_cols, _kind().alias("kind"), "n_src", "n_dst")
    )


def _kind() -> Column:
    return (
        F.when(F.col("n_dst") == 0, "added").when(F.col("n_src") == 0, "removed").otherwise("changed")
    )


# ---------------------------------------------------------------- mirror


def mirror_updates(
    spark: SparkSession,
    src: str,
    dst: str,
    mirrored_at,
    ledger: DataFrame | None = None,
    watermark: int | None = None,
    ledger_name: str | None = None,
    verify: bool = False,
) -> DataFrame:
    """Makes ``dst`` equal to ``src`` by rewriting only the partitions that changed.

    With a ledger and a watermark it knows, the partitions committed to since are
    taken; without (or with ``verify``) both tables are fingerprinted. Partitions
    gone from the source are dropped. Gives the mirror-log row to append:
    (table_name, snapshot_id, mirrored_at, rewritten, dropped), the latter two in
    partitions; its snapshot is the newest one at the start, so what is written
    meanwhile is found next time. Running it again changes nothing.
    """
    name = ledger_name or src
    pinned, touched = None, None
    if ledger is not None:
        # Pinned before the first read of the source.
        own = ledger.filter(F.col("table_name") == name)
        newest = latest_snapshot(own).first()
        pinned = None if newest is None else newest["snapshot_id"]
        known = watermark is not None and bool(
            own.filter(F.col("snapshot_id") == watermark).limit(1).count()
        )
        if known and pinned == watermark and not verify:
            return _log_row(spark, name, pinned, mirrored_at, 0, 0)
        if known:
            marks = spark.createDataFrame([Row(table_name=name, watermark=int(watermark))])
            touched = touched_partitions(own, marks).select("partition_values")
    rewritten, dropped = bring_up(spark, src, dst, None if verify else touched)
    return _log_row(spark, name, pinned, mirrored_at, rewritten, dropped)


def bring_up(spark: SparkSession, src: str, dst: str, touched: DataFrame | None) -> tuple[int, int]:
    """Makes ``dst`` equal to ``src``; gives the partitions rewritten and dropped.

    touched(partition_values) holds the partitions that can differ; without it the
    tables are compared. Changed partitions are written once, beside the old files, and
    then the target's names are pointed to them: until then, and if anything fails, the
    target is what it was. A target that shares files keeps sharing those of unchanged
    partitions. Managed targets, whose files move with their name, are overwritten in
    place, a partition at a time.
    """
    parts = partition_columns(spark, dst)
    if table_location(spark, src) == table_location(spark, dst):
        # A snapshot nobody has written to since: both names stand for one set of files.
        return 0, 0
    # Whatever was listed or cached before must not hide newer commits.
    spark.catalog.refreshTable(src)
    spark.catalog.refreshTable(dst)
    here, there = spark.table(src), spark.table(dst)
    if not parts:
        return _mirror_whole(spark, src, dst, touched is None), 0
    if touched is not None:
        changes = _ledger_changes(here, there, parts, touched)
    else:
        if get_property(spark, dst, SHARED_FILES) is not None:
            # Where both tables stand on the same files there is nothing to compare.
            differing = _differing_files(here, there, parts)
            here, there = only_partitions(here, differing, parts), only_partitions(there, differing, parts)
        changes = changed_partitions(here.select(*there.columns), there, parts)
    changes = pin(changes, "changed")

    wanted = changes.filter("kind <> 'removed'")
    rewritten = wanted.count()
    if rewritten:
        fresh = only_partitions(spark.table(src), wanted.select(*parts), parts).select(*there.columns)
        # Else each scan task reads files of one partition: nothing to shuffle.
        shuffle = partition_columns(spark, src) != parts
        if is_managed(spark, dst):
            with _overwriting_touched_only(spark):
                (spread(fresh, parts) if shuffle else fresh).write.insertInto(dst, overwrite=True)
        else:
            expected = wanted.select(*parts, "n_src", (F.col("kind") == "added").alias("is_new"))

            def recount() -> DataFrame:
                spark.catalog.refreshTable(src)
                return only_partitions(spark.table(src), wanted.select(*parts), parts)

            replace_partitions(spark, dst, fresh, parts, expected, shuffle, recount)
    gone = changes.filter("kind = 'removed'").select(*parts)
    dropped = drop_partitions(spark, dst, gone, parts)
    spark.catalog.refreshTable(dst)
    if rewritten or dropped:
        settle(spark, dst, parts)
    return rewritten, dropped


def _differing_files(src: DataFrame, dst: DataFrame, parts: list[str]) -> DataFrame:
    """Partitions whose files are not the same on both sides, by names and footers."""
    both = _sides(file_manifest(src, parts), file_manifest(dst, parts), F.col("file_path"), *[F.col(f"`{p}`") for p in parts])
    named = [F.col(f"`{p}`") for p in parts]
    sides = both.groupBy("file_path", *named).agg(F.count_if(F.col("__src")).alias("n_src"), F.count_if(~F.col("__src")).alias("n_dst"))
    return pin(sides.filter("n_src <> n_dst").select(*named).distinct(), "differing")


@contextlib.contextmanager
def _overwriting_touched_only(spark: SparkSession):
    """An overwrite replaces the partitions it has rows for and leaves the others.

    Writes into catalogue tables take this from the session only.
    """
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def _mirror_whole(spark: SparkSession, src: str, dst: str, compare: bool) -> int:
    """Unpartitioned tables are one partition: written anew when anything differs."""
    here, there = spark.table(src), spark.table(dst)
    if compare and changed_partitions(here.select(*there.columns), there, []).limit(1).count() == 0:
        return 0
    rows = here.select(*there.columns)
    if not is_managed(spark, dst) and is_parquet(spark, dst):
        own_whole(spark, dst, rows)
    else:
        pin(rows, "staged").write.insertInto(dst, overwrite=True)
        spark.catalog.refreshTable(dst)
    return 1


def _log_row(spark, name, snapshot_id, mirrored_at, rewritten, dropped) -> DataFrame:
    return _log(spark, [(name, snapshot_id, rewritten, dropped)], mirrored_at)


def _log(spark, rows: list[tuple], mirrored_at) -> DataFrame:
    schema = "table_name string, snapshot_id bigint, rewritten int, dropped int"
    return spark.createDataFrame(rows, schema).select(
        "table_name", "snapshot_id", moment(mirrored_at).alias("mirrored_at"), "rewritten", "dropped"
    )

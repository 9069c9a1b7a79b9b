"""User tables and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from carryall.functions.times import moment
from carryall.schemas import KEY

_SETTING = "spark.checkpoint.dir"

# Fixed value: property of a table that stands over another table's files.
SHARED_FILES = "shares-files-with"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as named by the cluster.

    Only a local session without the setting gets a folder of its own.
    """
    folder = spark.conf.get(_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {_SETTING} to a folder shared by all executors")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="carryall-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """An unused path in the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def fresh_name(label: str) -> str:
    return f"{label}_{uuid.uuid4().hex[:12]}"


def pin(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read back.

    Cuts the lineage for good: later steps see the same rows even after executors
    are lost, and the planner sees their true size.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def table_location(spark: SparkSession, table: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}")
    return described.filter("col_name = 'Location'").select("data_type").first()[0]


def is_parquet(spark: SparkSession, table: str) -> bool:
    """Does the table say that its files are Parquet?"""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter(
        F.col("col_name").isin("Provider", "InputFormat")
    )
    return any("parquet" in r["data_type"].lower() for r in described.collect())


def is_managed(spark: SparkSession, table: str) -> bool:
    return spark.catalog.getTable(table).tableType == "MANAGED"


def set_properties(spark: SparkSession, table: str, values: dict[str, str]) -> None:
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({property_list(values)})")


def get_property(spark: SparkSession, table: str, key: str) -> str | None:
    rows = spark.sql(f"SHOW TBLPROPERTIES {table}").filter(F.col("key") == key)
    found = rows.first()
    return None if found is None else found["value"]


def copy_rows(
    spark: SparkSession,
    src: str,
    dst: str,
    provider: str = "parquet",
    location: str | None = None,
    properties: dict[str, str] | None = None,
) -> None:
    """A new table ``dst`` with the columns, partitioning and all rows of ``src``.

    Created, filled and stamped in one statement under a name of its own. Only when it
    has as many rows as the source's footers (of Parquet) say does it take the name of
    ``dst``; an existing ``dst`` can be read until then, and is dropped after. The
    source's files are partitioned as the target's are to be, so the copy is a map over
    them and shuffles nothing.
    """
    parts = partition_columns(spark, src)
    listed = ", ".join(f"`{p}`" for p in parts)
    building = beside(dst)
    try:
        spark.sql(
            f"CREATE TABLE {building} USING {provider}"
            + (f" PARTITIONED BY ({listed})" if parts else "")
            + (f" LOCATION '{location}'" if location else "")
            + (f" TBLPROPERTIES ({property_list(properties)})" if properties else "")
            + f" AS SELECT * FROM {src}"
        )
        if provider == "parquet" and is_parquet(spark, src):
            spark.catalog.refreshTable(src)
            if spark.table(src).count() != spark.table(building).count():
                raise ValueError(f"{src} changed while it was copied")
        take_name(spark, building, dst)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {building}")
        raise


def beside(table: str) -> str:
    """An unused name next to a table's."""
    return f"{table.rstrip('`')}_{uuid.uuid4().hex[:8]}" + ("`" if table.endswith("`") else "")


def take_name(spark: SparkSession, building: str, dst: str) -> None:
    """Puts one table in the place of another, which is dropped once it is replaced."""
    if not spark.catalog.tableExists(dst):
        rename_table(spark, building, dst)
        return
    aside = beside(dst)
    rename_table(spark, dst, aside)
    try:
        rename_table(spark, building, dst)
    except Exception:
        rename_table(spark, aside, dst)
        raise
    spark.sql(f"DROP TABLE {aside}")


def rename_table(spark: SparkSession, old: str, new: str) -> None:
    """Renames a table within its catalog."""
    spark.sql(f"ALTER TABLE {old} RENAME TO {_in_catalog(new)}")
    if partition_columns(spark, new) and is_managed(spark, new):
        # The in-memory catalogue forgets where moved partitions are.
        spark.catalog.recoverPartitions(new)


def property_list(values: dict[str, str]) -> str:
    return ", ".join(f"'{k}'='{val}'" for k, val in values.items())


def spread(df: DataFrame, parts: list[str]) -> DataFrame:
    """Rows laid out for a partitioned write.

    Rebalancing brings a partition's rows together to avoid small files, and
    splits a partition that is too big for one task into several. Without
    partitions every task just writes its rows.
    """
    return df.hint("rebalance", *parts) if parts else df


def commit_rows(
    df: DataFrame, table: str, parts: list[str], snapshot_id: int, committed_at, operation: str
) -> DataFrame:
    """Ledger rows of one commit: a row per touched partition with its row count."""
    counts = df.groupBy(*parts).agg(F.count(F.lit(1)).alias("record_count"))
    return counts.select(
        F.lit(table).alias("table_name"),
        F.lit(snapshot_id).cast("bigint").alias("snapshot_id"),
        moment(committed_at).alias("committed_at"),
        F.lit(operation).alias("operation"),
        partition_map(parts).alias("partition_values"),
        F.col("record_count").cast("bigint").alias("record_count"),
    )


def partition_map(parts: list[str]):
    pairs = [c for p in parts for c in (F.lit(p), F.col(p).cast("string"))]
    return F.create_map(*pairs).cast("map<string,string>")


def probe_tables(spark: SparkSession, keys: DataFrame, spell=None) -> DataFrame:
    """Which of the named tables hold a row: their keys.

    For tables whose size nobody knows; each costs a one-row scan. ``spell``
    turns (catalog, db, table) into the name Spark knows.
    """
    spell = spell or dotted
    filled = []
    for row in keys.select(*KEY).distinct().toLocalIterator():
        if spark.table(spell(*row)).limit(1).count():
            filled.append(tuple(row))
    return spark.createDataFrame(filled, ", ".join(f"{c} string" for c in KEY))


def probe_folders(spark: SparkSession, located: DataFrame, provider: str = "parquet") -> DataFrame:
    """Which of the tables in located(key columns, location) hold a row: their keys.

    All folders are listed and read in one scan, so that the number of Spark jobs does not
    grow with that of the tables. Of Parquet only the footers are read; a file of another
    format counts as filled when it has a byte. A table may have several folders; files
    below a folder count as well. A location that is null or not there holds no row. To
    the driver come the locations.
    """
    wanted = located.filter(F.col("location").isNotNull()).select(*KEY, _plain(F.col("location")).alias("__root"))
    wanted = pin(wanted, "located")
    roots = [r["__root"] for r in wanted.select("__root").distinct().toLocalIterator()]
    roots = [r for r in roots if _is_there(spark, r)]
    if not roots:
        return wanted.select(*KEY).limit(0)
    if provider == "parquet":
        files = spark.read.schema("__none int").option("recursiveFileLookup", True).parquet(*roots)
        # The path of a file is written as in a URL.
        written = F.regexp_replace("_metadata.file_path", "[+]", "%2B")
        filled = files.select(F.url_decode(written).alias("path")).groupBy("path").agg(F.count(F.lit(1)).alias("n"))
    else:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(roots)
        filled = files.filter("length > 0").select("path")
    # Every folder above a file, so that files and tables meet by equality.
    steps = F.split(_plain(F.col("path")), "/")
    above = F.transform(F.sequence(F.lit(1), F.size(steps)), lambda n: F.array_join(F.slice(steps, 1, n), "/"))
    held = filled.select(F.explode(above).alias("__root")).distinct()
    return wanted.join(held, "__root", "left_semi").select(*KEY).distinct()


def _plain(path):
    """A location spelt in one way: local paths without their scheme, no closing slash."""
    return F.regexp_replace(F.regexp_replace(path, "^file:/+", "/"), "/+$", "")


def _is_there(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def dotted(catalog: str, db: str, tbl: str) -> str:
    return f"`{catalog}`.`{db}`.`{tbl}`"


def _in_catalog(name: str) -> str:
    """A table name without its catalog: a rename stays in the catalog it is in."""
    return ".".join(re.findall(r"`[^`]*`|[^.`]+", name)[-2:])


def rename_in_turn(spark: SparkSession, renames: list[tuple[str, str]]) -> int:
    """Renames the tables of one family, each once the name it takes is free; their number.

    A rename whose new name is there already was done by an earlier try.
    """
    pending = dict(renames)
    done = 0
    while pending:
        ready = [old for old, new in pending.items() if new not in pending]
        if not ready:
            raise ValueError(f"renames in a circle: {sorted(pending)}")
        for old in ready:
            new = pending.pop(old)
            if not spark.catalog.tableExists(new):
                rename_table(spark, old, new)
                done += 1
    return done


def run_drops(spark: SparkSession, plan: DataFrame, spell=None) -> int:
    """Drops the tables of a drop plan, one after the other; those gone already are passed over."""
    spell = spell or dotted
    done = 0
    for row in plan.select(*KEY).toLocalIterator():
        spark.sql(f"DROP TABLE IF EXISTS {spell(*row)}")
        done += 1
    return done


def run_renames(spark: SparkSession, plan: DataFrame, spell=None) -> int:
    """Carries out a rename plan on the session's tables; gives the number of renames.

    Only names come to the driver. A rename waits until the name it takes is free.
    """
    spell = spell or dotted
    pending = {}
    for row in plan.select(*KEY, "new_name").toLocalIterator():
        pending[(row[0], row[1], row[2])] = row["new_name"]
    done = 0
    while pending:
        ready = [k for k, new in pending.items() if (k[0], k[1], new) not in pending]
        if not ready:
            raise ValueError(f"renames in a circle: {sorted(pending)}")
        for key in ready:
            rename_table(spark, spell(*key), spell(key[0], key[1], pending.pop(key)))
            done += 1
    return done

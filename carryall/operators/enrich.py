"""Facts about the queued tables, joined in for all jobs at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from carryall import vocabulary as v
from carryall.functions import sets
from carryall.functions.names import qualified
from carryall.schemas import KEY


# ---------------------------------------------------------------- storage


def storage_format(output_format: Column) -> Column:
    return F.when(F.lower(output_format).contains("parquet"), v.PARQUET).otherwise(v.TEXT)


def classify_storage(catalog: DataFrame) -> DataFrame:
    """Adds stg_format: parquet when the output format says so, else csv/text."""
    return catalog.withColumn("stg_format", storage_format(F.col("output_format")))


def source_format(names: v.Naming = v.DEFAULT) -> Column:
    """Is this catalogue entry still in the source format?

    The table type decides when there is one, else the serde location does.
    """
    by_type = ~F.lower(F.col("table_type")).contains(names.target_marker)
    by_serde = F.coalesce(F.col("serde_uri").contains(names.source_marker), F.lit(False))
    return F.when(F.col("table_type").isNotNull(), by_type).otherwise(by_serde)


def classify_kind(jobs: DataFrame, catalog: DataFrame, names: v.Naming = v.DEFAULT) -> DataFrame:
    """Adds exists and is_source; a missing table is neither."""
    facts = catalog.select(*KEY, source_format(names).alias("__src"))
    return jobs.join(facts, KEY, "left").select(
        *jobs.columns,
        F.col("__src").isNotNull().alias("exists"),
        F.coalesce("__src", F.lit(False)).alias("is_source"),
    )


def timestamp_columns(fields: Column) -> Column:
    """Does a list of (name, source_type) hold a column that forces a rewrite?

    Columns called timestamp do not count, and a nested field of that name
    switches the test off for its whole column.
    """
    kind = lambda f: F.lower(f["source_type"])
    found = F.exists(
        fields,
        lambda f: (f["name"] != "timestamp")
        & F.coalesce(kind(f).contains("timestamp") & ~kind(f).contains("timestamp:"), F.lit(False)),
    )
    return F.coalesce(found, F.lit(False))


def detect_rewrite_types(catalog: DataFrame) -> DataFrame:
    """Adds has_ts: the table has a timestamp column and cannot be snapshotted."""
    return catalog.withColumn("has_ts", timestamp_columns(F.col("fields")))


def field_types(df: DataFrame) -> list[tuple[str, str]]:
    """(name, type text) of a DataFrame's columns, as kept in ``fields``."""
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]


def find_empty_tables(
    jobs: DataFrame, catalog: DataFrame, filled: DataFrame, names: v.Naming = v.DEFAULT
) -> DataFrame:
    """Adds is_empty: a source-format table of size 0, or of unknown size without rows.

    ``filled`` names the tables known to hold a row (``key`` columns, repeats
    allowed); only tables of unknown size are looked up in it, so a caller may
    probe just those (``unknown_size_tables``).
    """
    facts = catalog.select(*KEY, source_format(names).alias("__src"), "data_size")
    has_rows = filled.select(*KEY).distinct().withColumn("__rows", F.lit(True))
    joined = jobs.join(facts, KEY, "left").join(has_rows, KEY, "left")
    unknown = F.col("data_size").isNull() | (F.col("data_size") == -1)
    empty = F.coalesce("__src", F.lit(False)) & (
        F.coalesce(F.col("data_size") == 0, F.lit(False))
        | (unknown & F.col("__rows").isNull())
    )
    return joined.select(*jobs.columns, empty.alias("is_empty"))


def mark_empty(jobs: DataFrame, empty: DataFrame | None) -> DataFrame:
    """Jobs with is_empty, by the keys of empty tables unless the column is there."""
    if "is_empty" in jobs.columns:
        return jobs
    if empty is None:
        raise ValueError("give the keys of empty tables or jobs with is_empty")
    found = empty.select(*KEY).distinct().withColumn("is_empty", F.lit(True))
    return jobs.join(found, KEY, "left").withColumn(
        "is_empty", F.coalesce("is_empty", F.lit(False))
    )


def unknown_size_tables(
    jobs: DataFrame, catalog: DataFrame, names: v.Naming = v.DEFAULT
) -> DataFrame:
    """Keys of source-format tables whose size the catalogue does not know."""
    open_size = catalog.filter(
        source_format(names) & (F.col("data_size").isNull() | (F.col("data_size") == -1))
    )
    return open_size.select(*KEY).join(jobs.select(*KEY), KEY, "left_semi")


# ---------------------------------------------------------------- people


def event_owners(meta_events: DataFrame) -> DataFrame:
    """The owner id in the newest metadata event of each table: (table_name, user).

    The id is taken out of the document before anything is shuffled, and all buffers
    have a fixed width, so that every aggregation hashes: events are folded to one row
    per table and id, then the newest time and, among ids of one time, the one with the
    greatest hash is looked up. An event without a time is older than all others; an
    event without an owner counts, and gives a null.
    """
    document = F.col("current_json")
    at = F.unix_micros(F.col("event_time").cast("timestamp"))
    seen = (
        meta_events.filter((F.col("table_name") != "") & document.isNotNull() & (document != ""))
        .select(
            "table_name",
            F.get_json_object(document, "$.definitionMetadata.owner.userId").alias("user"),
            F.coalesce(at, F.lit(-(1 << 63))).alias("at"),
        )
        .groupBy("table_name", "user")
        .agg(F.max("at").alias("at"))
        .withColumn("tie", F.xxhash64("user"))
    )
    last = (
        seen.groupBy("table_name", "at")
        .agg(F.max("tie").alias("tie"))
        .groupBy("table_name")
        .agg(F.max("at").alias("at"), F.max_by("tie", "at").alias("tie"))
    )
    return seen.join(last, ["table_name", "at", "tie"], "left_semi").select("table_name", "user")


def owner_candidates(
    contacts: DataFrame,
    meta_daily: DataFrame,
    meta_events: DataFrame,
    day_key: int,
    names: v.Naming = v.DEFAULT,
    due: DataFrame | None = None,
) -> DataFrame:
    """Owners of every known table, or of those in ``due``: (table_name, owners, found_in).

    In order: live contacts when there are any; else the day's metadata row when
    there is one, even an empty one; else the owner id in the newest metadata
    event plus the mail domain. Of several rows of one table and source, the one with
    the least hash of its owners counts.

    contacts(table_name, contacts array), meta_daily(table_name, contacts array,
    dateint), meta_events(table_name, event_time, current_json), due(table_name).
    """

    def of_due(rows):
        return rows if due is None else rows.join(due.select("table_name"), "table_name", "left_semi")

    live = of_due(contacts.select("table_name", "contacts")).select(
        "table_name", F.lit(1).alias("rank"), sets.as_set(F.col("contacts")).alias("owners")
    ).filter(F.size("owners") > 0)
    daily = of_due(meta_daily.filter(F.col("dateint") == day_key).select("table_name", "contacts")).select(
        "table_name", F.lit(2).alias("rank"), sets.as_set(F.col("contacts")).alias("owners")
    )
    from_event = of_due(event_owners(meta_events)).select(
        "table_name",
        F.lit(3).alias("rank"),
        sets.as_set(F.array(F.concat("user", F.lit(names.mail_domain)))).alias("owners"),
    )
    # Rank and hash in one number: the least one of a table is found without sorting.
    mask = F.lit((1 << 56) - 1)
    choice = F.shiftleft(F.col("rank").cast("bigint"), 56) + F.xxhash64("owners").bitwiseAND(mask)
    ranked = live.unionByName(daily).unionByName(from_event).withColumn("choice", choice)
    best = ranked.groupBy("table_name").agg(F.min("choice").alias("choice"))
    return (
        ranked.join(best, ["table_name", "choice"], "left_semi")
        .select("table_name", "owners", F.col("rank").alias("found_in"))
        .distinct()
    )


def resolve_owners(
    jobs: DataFrame,
    contacts: DataFrame,
    meta_daily: DataFrame,
    meta_events: DataFrame,
    day_key: int,
    names: v.Naming = v.DEFAULT,
) -> DataFrame:
    """Adds tbl_owners to every job; tables without a known owner get the empty set.

    Of the sources only the rows of the given jobs' tables are looked at.
    """
    due = jobs.select(qualified("/").alias("table_name")).distinct()
    owners = owner_candidates(contacts, meta_daily, meta_events, day_key, names, due)
    kept = [c for c in jobs.columns if c != "tbl_owners"]
    return (
        jobs.withColumn("__name", qualified("/"))
        .join(owners.withColumnRenamed("table_name", "__name"), "__name", "left")
        .select(*kept, F.coalesce("owners", sets.empty_set()).alias("tbl_owners"))
    )


def with_domain(user: Column, names: v.Naming = v.DEFAULT) -> Column:
    """The user's address: the domain is added unless it occurs in the name."""
    return F.when(user.contains(names.mail_domain), user).otherwise(
        F.concat(user, F.lit(names.mail_domain))
    )


def readers(lineage: DataFrame, names: v.Naming = v.DEFAULT) -> DataFrame:
    """Distinct (source_name, downstream_user) of all read operations.

    Repeats fall away map-side and the shuffle key has both columns, so a table
    that fills a third of the lineage is still spread over all tasks.
    """
    return (
        lineage.filter((F.col("operation") == "read") & F.col("user_id").isNotNull())
        .select("source_name", with_domain(F.col("user_id"), names).alias("downstream_user"))
        .distinct()
    )


def downstream_users(jobs: DataFrame, lineage: DataFrame, names: v.Naming = v.DEFAULT) -> DataFrame:
    """(task_id, key, downstream_user): one row per job and reader, any number of them."""
    named = jobs.select("task_id", *KEY, qualified("/").alias("source_name"))
    return readers(lineage, names).join(named, "source_name").select(
        "task_id", *KEY, "downstream_user"
    )


def fold_sets(pairs: DataFrame, key: list[str], member: str, out: str) -> DataFrame:
    """Distinct pairs as one sorted set per key: the export for the queue's set columns.

    A set is one row whatever its size, as the column wants it. Nothing that is
    sent out is made from it: mails start from the pairs.
    """
    return pairs.groupBy(*key).agg(F.array_sort(F.collect_set(member)).alias(out))


def data_category(tags: Column) -> Column:
    """Category from a map of privacy tags; no map or no known tag is UNKNOWN."""
    pi = F.try_element_at(tags, F.lit("pi"))
    core = F.coalesce(F.map_contains_key(tags, "core_pi"), F.lit(False))
    return (
        F.when(core, v.CORE_PI)
        .when(pi == "yes", v.PI)
        .when(pi == "no", v.NO_PI)
        .otherwise(v.UNKNOWN)
    )


def categorize(jobs: DataFrame, metadata: DataFrame) -> DataFrame:
    """Adds data_category from metadata(table_name, category_tags map)."""
    kept = [c for c in jobs.columns if c != "data_category"]
    facts = metadata.select(F.col("table_name").alias("__name"), "category_tags")
    return (
        jobs.withColumn("__name", qualified("/"))
        .join(facts, "__name", "left")
        .select(*kept, data_category(F.col("category_tags")).alias("data_category"))
    )


def owner_tables(jobs: DataFrame) -> DataFrame:
    """Distinct (owner, table) pairs, names written with dots.

    Kept as pairs: an owner may hold a large share of all tables.
    """
    return jobs.select(F.explode("tbl_owners").alias("owner"), qualified(".").alias("table")).distinct()
